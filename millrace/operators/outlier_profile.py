"""Whole-row outlier profile, distribution statistics, and automatic choice of a detector."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import finite, number, numeric_columns
from millrace.operators.base import Fitted, Step
from millrace.operators.outliers import (
    OutlierModel, OutlierRule, Outliers, OutlierSettings, is_infinite,
)
from millrace.plans.quantiles import quantiles
from millrace.plans.statistics import statistics

DEFAULT_THRESHOLD = {"iqr": 1.5, "zscore": 3.0}


@dataclass(frozen=True)
class ProfileSettings:
    """``iqr`` (strict bounds) or ``zscore`` (sample deviation, ``>=``); anything else means iqr 1.5."""

    method: str = "iqr"
    threshold: float | None = None
    columns: tuple[str, ...] | None = None

    def resolved(self) -> tuple[str, float]:
        method = self.method.lower()
        if method not in DEFAULT_THRESHOLD:
            return "iqr", DEFAULT_THRESHOLD["iqr"]
        given = self.threshold is not None
        return method, float(self.threshold) if given else DEFAULT_THRESHOLD[method]


class ProfileModel(Fitted):
    def _judged(self, df: DataFrame) -> dict[str, tuple[Column, Column]]:
        """``{column: (flag, score)}``; the score is |z|, or the value itself under iqr."""
        method, threshold = self.settings.resolved()
        judged = {}
        for name, s in self.state.items():
            if name not in df.columns:
                continue
            x = number(df, name)
            if method == "zscore":
                spread = F.lit(s["std"])
                score = F.when(spread != 0, F.abs((x - F.lit(s["mean"])) / F.nullif(spread, F.lit(0.0))))
                flag = score >= F.lit(threshold)
            else:
                score = x
                flag = (x < F.lit(s["lower_bound"])) | (x > F.lit(s["upper_bound"]))
            judged[name] = (F.coalesce(flag | is_infinite(x), F.lit(False)), score)
        return judged

    def row_flag(self, df: DataFrame) -> Column:
        return reduce(lambda a, b: a | b, (f for f, _ in self._judged(df).values()), F.lit(False))

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return {"is_outliers": self.row_flag(df)}

    def details(self, df: DataFrame, row_id: str) -> DataFrame:
        """One row per outlier row: the columns that make it one, and their scores."""
        judged = self._judged(df)
        tags = F.array_compact(F.array(*(F.when(f, F.lit(c)) for c, (f, _) in judged.items())))
        scores = F.array_compact(F.array(*(F.when(f, s) for f, s in judged.values())))
        return (
            df.where(self.row_flag(df))
            .select(row_id, tags.alias("extreme_tag"), scores.alias("extreme_scores"))
        )

    def info(self, df: DataFrame) -> DataFrame:
        """Per column with outliers: method, count, threshold."""
        method, threshold = self.settings.resolved()
        judged = self._judged(df)
        row = df.agg(*(F.count_if(f).alias(f"c{i}") for i, (f, _) in enumerate(judged.values()))).first()
        rows = [(c, method, row[f"c{i}"], threshold) for i, c in enumerate(judged) if row[f"c{i}"]]
        return df.sparkSession.createDataFrame(
            rows, "column string, method string, outlier_count long, threshold double"
        )

    def keep_normal(self, df: DataFrame) -> DataFrame:
        return df.where(~self.row_flag(df))

    def mark(self, df: DataFrame) -> DataFrame:
        return df.withColumn("is_entire_outlier", self.row_flag(df).cast("int"))

    def blank_rows(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Every column of a flagged row becomes NULL, except the named key columns."""
        flag = self.row_flag(df)
        from millrace.functions.columns import col

        return df.select(
            *(col(c) if c in keep else F.when(~flag, col(c)).alias(c) for c in df.columns)
        )


class OutlierProfile(Step):
    """Flags a row when any of its numeric columns is extreme."""

    model = ProfileModel

    def __init__(self, settings: ProfileSettings | None = None, pass_through: bool = False):
        super().__init__(settings or ProfileSettings(), pass_through)

    def learn(self, df: DataFrame) -> dict[str, dict]:
        method, threshold = self.settings.resolved()
        names = numeric_columns(df) if self.settings.columns is None else self.settings.columns
        values = {c: finite(df, c) for c in names}
        stats = statistics(df, values, ["n", "mean", "std_sample", "min", "max"])
        if method == "zscore":
            return {
                c: {"mean": s["mean"], "std": s["std_sample"]}
                for c, s in stats.items()
                if s["n"] >= 2
            }
        enough = {c: values[c] for c in names if stats[c]["n"] >= 4}
        quarters = quantiles(df, {c: (v, [0.25, 0.75]) for c, v in enough.items()}, stats)
        state = {}
        for c, (q1, q3) in quarters.items():
            reach = threshold * (q3 - q1)
            state[c] = {"q1": q1, "q3": q3, "lower_bound": q1 - reach, "upper_bound": q3 + reach}
        return state


def normality_p(n: int, skewness: float | None, kurtosis: float | None) -> float:
    """p-value of the D'Agostino–Pearson K² test from population moments (``kurtosis`` is excess).

    Published closed forms: D'Agostino (1970) for skewness, Anscombe–Glynn (1983) for kurtosis.
    """
    if n <= 20 or skewness is None or kurtosis is None:
        return 0.0
    y = skewness * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
    beta /= (n - 2.0) * (n + 5) * (n + 7) * (n + 9)
    w = math.sqrt(2 * (beta - 1)) - 1
    z_skew = math.asinh(y / math.sqrt(2 / (w - 1))) / math.sqrt(0.5 * math.log(w))

    expected = 3.0 * (n - 1) / (n + 1)
    variance = 24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) ** 2 * (n + 3) * (n + 5))
    x = (kurtosis + 3 - expected) / math.sqrt(variance)
    root_b1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7.0) * (n + 9))
    root_b1 *= math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3)))
    a = 6 + 8 / root_b1 * (2 / root_b1 + math.sqrt(1 + 4 / root_b1**2))
    d = 1 + x * math.sqrt(2 / (a - 4))
    if d == 0:
        return 0.0
    cube = math.copysign(abs((1 - 2 / a) / abs(d)) ** (1 / 3), d)
    z_kurt = (1 - 2 / (9 * a) - cube) / math.sqrt(2 / (9 * a))
    return math.exp(-(z_skew**2 + z_kurt**2) / 2)


def _distribution(stats: dict, skew_limit: float, kurt_limit: float) -> dict:
    n, skew, kurt = stats["n"], stats["skew"], stats["kurt"]
    if n < 10:
        return {
            "n_samples": n, "skewness": None, "kurtosis": None, "normality_p": None,
            "is_normal": None, "is_skewed": None, "is_heavy_tailed": None,
        }
    p = normality_p(n, skew, kurt)
    return {
        "n_samples": n,
        "skewness": skew,
        "kurtosis": kurt,
        "normality_p": p,
        "is_normal": p > 0.05,
        "is_skewed": skew is not None and abs(skew) > skew_limit,
        "is_heavy_tailed": kurt is not None and kurt > kurt_limit,
    }


DISTRIBUTION_SCHEMA = (
    "column string, n_samples long, skewness double, kurtosis double, normality_p double, "
    "is_normal boolean, is_skewed boolean, is_heavy_tailed boolean"
)


def _analyse(df: DataFrame, columns, skew_limit: float, kurt_limit: float) -> dict[str, dict]:
    stats = statistics(df, {c: number(df, c) for c in columns}, ["n", "skew", "kurt"])
    return {c: _distribution(s, skew_limit, kurt_limit) for c, s in stats.items()}


def distribution_stats(
    df: DataFrame, columns: list[str], skew_limit: float = 1.0, kurt_limit: float = 3.0
) -> DataFrame:
    """Shape of every column, all moments from one aggregate; fewer than 10 values give NULLs."""
    shapes = _analyse(df, columns, skew_limit, kurt_limit)
    rows = [(c, *shape.values()) for c, shape in shapes.items()]
    return df.sparkSession.createDataFrame(rows, DISTRIBUTION_SCHEMA)


@dataclass(frozen=True)
class SmartSettings:
    columns: tuple[str, ...]
    default_method: str = "iqr"
    auto_select: bool = True
    skew_limit: float = 1.0
    kurt_limit: float = 3.0


def choose_method(shape: dict, default: str) -> tuple[str, str]:
    """Detector and reason for one column's shape."""
    if shape["n_samples"] < 10:
        return "iqr", "too few values"
    if shape["is_normal"] and not shape["is_skewed"]:
        return "zscore", "close to normal"
    if shape["is_skewed"]:
        return "iqr", "skewed"
    if shape["is_heavy_tailed"]:
        return "mad", "heavy tails"
    return default, "default"


class SmartModel(OutlierModel):
    """Chosen detectors; ``shapes`` and ``reasons`` keep why."""

    shapes: dict[str, dict]
    reasons: dict[str, str]

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        return {f"is_outlier_{c}": f for c, f in self.flags(df).items()}

    def report_methods(self, spark: SparkSession) -> DataFrame:
        rows = []
        for c, shape in self.shapes.items():
            method = next(r.method for r in self.settings.rules if r.column == c)
            rows.append(
                (c, method, self.reasons[c], shape["skewness"], shape["kurtosis"], shape["normality_p"])
            )
        return spark.createDataFrame(
            rows,
            "column string, method string, reason string, skewness double, kurtosis double, "
            "normality_p double",
        )


class SmartOutliers(Step):
    """Pick z-score (t=3), iqr (1.5) or mad (3) per column by its shape, then learn thresholds."""

    def _fit(self, df: DataFrame):
        s = self.settings
        shapes = _analyse(df, s.columns, s.skew_limit, s.kurt_limit)
        rules, reasons = [], {}
        for c, shape in shapes.items():
            if shape["n_samples"] == 0:
                continue
            method, reason = choose_method(shape, s.default_method)
            if not s.auto_select:
                method, reason = s.default_method, "chosen by the user"
            reasons[c] = reason
            rules.append(OutlierRule(c, method, threshold={"iqr": 1.5}.get(method, 3.0)))
        settings = OutlierSettings(tuple(rules))
        fitted = SmartModel(settings, Outliers(settings).learn(df))
        fitted.shapes = {c: shapes[c] for c in reasons}
        fitted.reasons = reasons
        return fitted
