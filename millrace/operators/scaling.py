"""Scaling: learned linear maps per column, their inverse, and a choice by shape."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import finite, number, numeric_columns, present
from millrace.operators.base import Fitted, Step
from millrace.operators.missing import INDICATOR
from millrace.plans.sources import RowSource
from millrace.plans.statistics import statistics

SCALERS = ("minmax", "standard", "robust")
SKIPPED = ("user_skip", "cons_skip", "standard_skip", "flag_skip", "skip_all")

# Algorithms whose results do not depend on the scale of a feature.
SCALE_FREE = (
    "decision_tree", "random_forest", "extra_trees", "gradient_boosting", "xgboost", "lightgbm",
    "catboost", "naive_bayes",
)


@dataclass(frozen=True)
class Scaler:
    method: str
    feature_range: tuple[float, float] = (0, 1)
    with_mean: bool = True
    with_std: bool = True
    quantile_range: tuple[float, float] = (25, 75)

    def __post_init__(self):
        if self.method not in SCALERS:
            raise ValueError(f"unknown scaler {self.method!r}; use one of {SCALERS}")
        for name in ("feature_range", "quantile_range"):
            pair = getattr(self, name)
            if (
                not isinstance(pair, (tuple, list))
                or len(pair) != 2
                or any(isinstance(p, bool) or not isinstance(p, (int, float)) for p in pair)
                or pair[0] >= pair[1]
            ):
                raise ValueError(f"{name} must be an ordered pair of numbers")


@dataclass(frozen=True)
class ScaleSettings:
    """``scalers`` per column; other numeric columns get a recommendation unless ``only_listed``."""

    scalers: dict[str, Scaler] = field(default_factory=dict)
    skip: tuple[str, ...] = ()
    algorithm: str = "neural_network"
    only_listed: bool = False

    def __post_init__(self):
        if len(set(self.skip)) != len(self.skip):
            raise ValueError("skip_scale names a column twice")
        both = sorted(set(self.skip) & set(self.scalers))
        if both:
            raise ValueError(f"columns both in transformers and skip_scale: {both}")

    @classmethod
    def from_dict(cls, config: dict | None, **options) -> "ScaleSettings":
        """Read ``{"transformers": [{method: {columns, …}}], "skip_scale": […]}``."""
        config, scalers = config or {}, {}
        for entry in config.get("transformers", []):
            for method, given in entry.items():
                rest = {k: v for k, v in given.items() if k != "columns"}
                scaler = Scaler(method, **rest)
                for c in given.get("columns", []):
                    if c in scalers:
                        raise ValueError(f"{c} appears in more than one transformer")
                    scalers[c] = scaler
        return cls(scalers, tuple(config.get("skip_scale", ())), **options)


class ScaleModel(Fitted):
    """``state[column]``: method and, when scaled, ``(x - center) * factor + shift``."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        made = {}
        for name in present(df, self.state):
            s = self.state[name]
            if s["method"] in SCALERS:
                x = number(df, name)
                made[name] = (x - F.lit(s["center"])) * F.lit(s["factor"]) + F.lit(s["shift"])
        return made

    def inverse(self, df: DataFrame, columns: dict[str, str] | list[str] | None = None) -> DataFrame:
        """Back to original units: all scaled columns, the named ones, or ``{column: learned as}``."""
        if not isinstance(columns, dict):
            columns = {c: c for c in (self.state if columns is None else columns)}
        made = {}
        for name, learned_as in columns.items():
            s = self.state.get(learned_as)
            if s and s["method"] in SCALERS and name in df.columns:
                unshifted = (number(df, name) - F.lit(s["shift"])) / F.lit(s["factor"])
                made[name] = unshifted + F.lit(s["center"])
        return df.withColumns(made) if made else df

    def report(self, spark: SparkSession) -> DataFrame:
        """Method per column; the row ``*`` counts the columns."""
        rows = [(c, s["method"], s["method"] in SCALERS) for c, s in self.state.items()]
        scaled = sum(r[2] for r in rows)
        summary = ("*", f"{scaled} of {len(rows)} scaled", scaled > 0)
        return spark.createDataFrame([*rows, summary], "column string, method string, scaled boolean")


def _is_flag_name(name: str) -> bool:
    return name.startswith(("is_outlier_", "is_entire_outlier")) or name.endswith(INDICATOR)


class Scale(Step):
    """Statistics of all columns come from one aggregate and all quantiles from one search.

    Infinite values take no part in fitting. Listed columns use their scaler, everything else the
    recommendation: nothing for scale-free algorithms, constant, empty or 0/1 columns; ``robust``
    where |skewness| > 1 or values lie outside 1.5 interquartile ranges; ``standard`` otherwise.
    """

    model = ScaleModel

    def __init__(self, settings: ScaleSettings | None = None, pass_through: bool = False):
        super().__init__(settings or ScaleSettings(), pass_through)

    def learns_from_summaries(self) -> bool:
        return True

    def summary_columns(self, df: DataFrame) -> tuple[list[str], list[str]]:
        listed = present(df, self.settings.scalers)
        return (listed if self.settings.only_listed else numeric_columns(df)), []

    def learn(self, df: DataFrame, source=None) -> dict[str, dict]:
        s, source = self.settings, source or RowSource(df)
        state = {c: {"method": "user_skip"} for c in present(df, s.skip)}
        listed = present(df, s.scalers)
        others = [] if s.only_listed else [c for c in numeric_columns(df) if c not in s.scalers]
        names = [*listed, *(c for c in others if c not in state)]
        if s.algorithm in SCALE_FREE:
            return state | {c: {"method": "skip_all"} for c in names}
        values = {c: finite(df, c) for c in names}
        stats = source.statistics(values, ["n", "mean", "std", "min", "max", "skew", "not_flag"])
        wanted: dict[str, list[float]] = {}
        for c in names:
            if stats[c]["n"] == 0:
                state[c] = {"method": "standard_skip"}
            elif stats[c]["min"] == stats[c]["max"]:
                state[c] = {"method": "cons_skip"}
            elif c not in s.scalers and (_is_flag_name(c) or stats[c]["not_flag"] == 0):
                state[c] = {"method": "flag_skip"}
            elif c not in s.scalers:
                wanted[c] = [0.25, 0.5, 0.75]
            elif s.scalers[c].method == "robust":
                low, high = s.scalers[c].quantile_range
                wanted[c] = [low / 100, 0.5, high / 100]
        found = source.quantiles({c: (values[c], q) for c, q in wanted.items()}, stats)
        for c in names:
            if c not in state:
                scaler = s.scalers.get(c) or _recommended(stats[c], found[c])
                state[c] = _linear(scaler, stats[c], found.get(c))
        return state


def _recommended(stats: dict, quarters: list[float]) -> Scaler:
    q1, _, q3 = quarters
    reach = 1.5 * (q3 - q1)
    outside = stats["min"] < q1 - reach or stats["max"] > q3 + reach
    skewed = stats["skew"] is not None and abs(stats["skew"]) > 1
    return Scaler("robust" if (skewed or outside) and q3 > q1 else "standard")


def _linear(scaler: Scaler, stats: dict, quarters: list[float] | None) -> dict:
    center, factor, shift = 0.0, 1.0, 0.0
    if scaler.method == "minmax":
        low, high = scaler.feature_range
        center, shift = stats["min"], float(low)
        factor = (high - low) / (stats["max"] - stats["min"])
    elif scaler.method == "standard":
        center = stats["mean"] if scaler.with_mean else 0.0
        factor = 1.0 / stats["std"] if scaler.with_std and stats["std"] else 1.0
    else:
        low, center, high = quarters
        factor = 1.0 / (high - low) if high > low else 1.0
    return {"method": scaler.method, "center": center, "factor": factor, "shift": shift}


def scaling_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: values used, mean, population deviation, min, max, constant or not."""
    stats = statistics(df, {c: finite(df, c) for c in columns}, ["n", "mean", "std", "min", "max"])
    rows = [
        (c, s["n"], s["mean"], s["std"], s["min"], s["max"], bool(s["n"]) and s["min"] == s["max"])
        for c, s in stats.items()
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column string, n_samples long, mean double, std double, min double, max double, "
        "is_constant boolean",
    )
