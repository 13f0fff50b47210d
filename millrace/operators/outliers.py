"""Numeric outliers: thresholds learned once per column, flags and repairs as expressions.

Three meanings of nearby words are kept apart: ``robust`` is a pair of percentiles, ``mad`` is the
median / median-absolute-deviation score, and a z-score here uses the population deviation with a
strict comparison (the profile in ``outlier_profile`` uses the sample deviation and ``>=``).
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, finite, number
from millrace.operators.base import Fitted, Step
from millrace.plans.isolation import TREE_ROWS, TREES, anomalous_ranges, in_ranges
from millrace.plans.quantiles import quantiles
from millrace.plans.sources import RowSource

METHODS = ("zscore", "iqr", "robust", "mad", "isolationforest", "custom", "minmax_business")
HANDLING = ("clip", "nan", "impute", "constant", "custom", "mark")
MAD_TO_DEVIATION = 0.6745
NOTHING = "no_need"


@dataclass(frozen=True)
class OutlierRule:
    """How one column is judged and repaired.

    ``detect_function(value) -> flag`` and ``handle_function(value, flag, numbers) -> value`` build
    column expressions; ``numbers`` holds the learned mean, median, min and max.
    """

    column: str
    method: str
    handle: str = "mark"
    threshold: float | None = None
    quantile_range: tuple[float, float] = (10, 90)
    contamination: float = 0.1
    random_state: int = 42
    trees: int = TREES
    tree_rows: int = TREE_ROWS
    feature_range_business: tuple[float, float] | None = None
    detect_function: Callable[[Column], Column] | None = None
    handle_function: Callable[[Column, Column, dict], Column] | None = None
    constant_value: float | None = None

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"unknown detection method {self.method!r}; use one of {METHODS}")
        if self.handle not in HANDLING:
            raise ValueError(f"unknown handling {self.handle!r}; use one of {HANDLING}")
        if self.method in ("zscore", "iqr") and self.threshold is None:
            raise ValueError(f"{self.method} needs a threshold")
        if self.method == "custom" and self.detect_function is None:
            raise ValueError("custom detection needs detect_function")
        if self.handle == "custom" and self.handle_function is None:
            raise ValueError("custom handling needs handle_function")
        if self.handle == "constant" and self.constant_value is None:
            raise ValueError("constant handling needs constant_value")
        if self.method == "minmax_business" and not _ordered_pair(self.feature_range_business):
            raise ValueError("feature_range_business must be an ordered pair of numbers")
        if self.method == "robust" and not _ordered_pair(self.quantile_range):
            raise ValueError("quantile_range must be an ordered pair of percentages")


def _ordered_pair(value) -> bool:
    return (
        isinstance(value, (tuple, list))
        and len(value) == 2
        and all(isinstance(v, (int, float)) for v in value)
        and value[0] < value[1]
    )


@dataclass(frozen=True)
class OutlierSettings:
    """Rules in order. The first rule of a column repairs it; all rules feed the row flag."""

    rules: tuple[OutlierRule, ...]
    indicators: tuple[str, ...] = ()
    row_id: str | None = None

    @classmethod
    def from_dict(cls, config: dict, row_id: str | None = None) -> "OutlierSettings":
        """Read ``{"detect_and_handle_config": [{method: {columns, handle_method, …}}], …}``."""
        rules = []
        for entry in config.get("detect_and_handle_config", []):
            for method, options in entry.items():
                if method not in METHODS:
                    raise ValueError(f"unknown detection method {method!r}; use one of {METHODS}")
                if "columns" not in options or "handle_method" not in options:
                    raise ValueError("columns and handle_method are required")
                columns, handles = options["columns"], options["handle_method"]
                if len(columns) != len(handles):
                    raise ValueError("give one handle_method per column")
                rest = {k: v for k, v in options.items() if k not in ("columns", "handle_method")}
                rules += [
                    OutlierRule(c, method, h, **rest) for c, h in zip(columns, handles, strict=True)
                ]
        return cls(tuple(rules), tuple(config.get("generate_outlier_indicator", ())), row_id)


def _shares(rule: OutlierRule) -> list[float]:
    if rule.method == "iqr":
        shares = [0.25, 0.75]
    elif rule.method == "robust":
        shares = [q / 100 for q in rule.quantile_range]
    else:
        shares = []
    return shares + [0.5]


def is_infinite(x: Column) -> Column:
    """Infinities are learned from by no rule, and outliers by each."""
    return F.abs(x) == F.lit(float("inf"))


def _works(df: DataFrame, rule: OutlierRule, x: Column) -> bool:
    """Whether the user's detector makes a condition of the column; if not, the column is left alone."""
    try:
        kind = df.select(rule.detect_function(x).alias("flag")).schema["flag"].dataType
    except Exception as error:
        warnings.warn(f"detector of {rule.column} failed and is skipped: {error}", stacklevel=2)
        return False
    if not isinstance(kind, T.BooleanType):
        warnings.warn(f"detector of {rule.column} gives no condition and is skipped", stacklevel=2)
    return isinstance(kind, T.BooleanType)


class OutlierModel(Fitted):
    """``state[column]["rules"]`` lists what each rule of the column learned."""

    def rules_for(self, df: DataFrame) -> dict[str, list[tuple[OutlierRule, dict]]]:
        found: dict[str, list] = {}
        for rule in self.settings.rules:
            if rule.column in df.columns and rule.column in self.state:
                place = len(found.setdefault(rule.column, []))
                found[rule.column].append((rule, self.state[rule.column]["rules"][place]))
        return found

    @staticmethod
    def _flag(df: DataFrame, rule: OutlierRule, learned: dict) -> Column:
        x, method = number(df, rule.column), learned["detect_method"]
        if method == NOTHING:
            return F.lit(False)
        if method == "zscore":
            score = F.abs(x - F.lit(learned["mean"])) / F.lit(learned["std"])
            flag = score > F.lit(float(learned["threshold"]))
        elif method == "mad":
            score = F.abs(F.lit(MAD_TO_DEVIATION) * (x - F.lit(learned["median"])))
            flag = score / F.lit(learned["mad"]) > F.lit(float(learned["threshold"]))
        elif method == "isolationforest":
            flag = in_ranges(x, learned["ranges"])
        elif method == "custom":
            return F.coalesce(rule.detect_function(x), F.lit(False))
        else:
            flag = (x < F.lit(learned["lower_bound"])) | (x > F.lit(learned["upper_bound"]))
        return F.coalesce(flag | is_infinite(x), F.lit(False))

    def flags(self, df: DataFrame) -> dict[str, Column]:
        """Outlier flag per column, by its first rule."""
        return {c: self._flag(df, *rules[0]) for c, rules in self.rules_for(df).items()}

    def row_flag(self, df: DataFrame) -> Column:
        """True where any rule of any column holds."""
        hit = F.lit(False)
        for rules in self.rules_for(df).values():
            for rule, learned in rules:
                hit = hit | self._flag(df, rule, learned)
        return hit

    @staticmethod
    def _repair(df: DataFrame, rule: OutlierRule, learned: dict, flag: Column, how: str) -> Column | None:
        x = col(rule.column)
        if learned["detect_method"] == NOTHING:
            return None
        if how == "nan":
            return F.when(~flag, x)
        if how == "impute":
            return F.when(flag, F.lit(learned["median"])).otherwise(x)
        if how == "constant":
            return F.when(flag, F.lit(rule.constant_value)).otherwise(x)
        if how == "custom":
            return rule.handle_function(x, flag, learned)
        if how == "clip":
            value = number(df, rule.column)
            low, high = F.lit(learned["lower_bound"]), F.lit(learned["upper_bound"])
            return F.when(value < low, low).when(value > high, high).otherwise(value)
        return None

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        """Each column repaired as its first rule says; marked and indicator columns as 0/1."""
        made, flags = {}, self.flags(df)
        for name, rules in self.rules_for(df).items():
            rule, learned = rules[0]
            if rule.handle == "mark" or name in self.settings.indicators:
                made[f"is_outlier_{name}"] = flags[name].cast("int")
            repaired = self._repair(df, rule, learned, flags[name], rule.handle)
            if repaired is not None:
                made[name] = repaired
        return made

    def keep_normal(self, df: DataFrame) -> DataFrame:
        """Drop every row with an outlier in it. Changes the row count."""
        return df.where(~self.row_flag(df))

    def mark(self, df: DataFrame) -> DataFrame:
        """Add a BOOLEAN ``is_outlier_<column>`` per judged column; values stay."""
        return df.withColumns({f"is_outlier_{c}": f for c, f in self.flags(df).items()})

    def repair_all(self, df: DataFrame, how: str) -> DataFrame:
        """Repair all judged columns one way, whatever their rules say: ``nan`` or ``impute``."""
        flags = self.flags(df)
        made = {
            c: self._repair(df, *rules[0], flags[c], how) for c, rules in self.rules_for(df).items()
        }
        return df.withColumns({c: e for c, e in made.items() if e is not None})

    def mixed(self, df: DataFrame, plan: dict[str, list[str]]) -> DataFrame:
        """``{"custom": columns → 0, "nan": columns → NULL}``; every other column gets a 0/1 mark."""
        how = {c: method for method, columns in plan.items() for c in columns}
        made = {}
        for name, flag in self.flags(df).items():
            if how.get(name) == "custom":
                made[name] = F.when(flag, F.lit(0)).otherwise(col(name))
            elif how.get(name) == "nan":
                made[name] = F.when(~flag, col(name))
            else:
                made[f"is_outlier_{name}"] = flag.cast("int")
        return df.withColumns(made)

    def report(self, df: DataFrame, strategy: str = "mark") -> DataFrame:
        """Flagged rows in total and per rule, from one aggregate."""
        listed = [(r, s) for rules in self.rules_for(df).values() for r, s in rules]
        row = df.agg(
            F.count_if(self.row_flag(df)).alias("total"),
            *(F.count_if(self._flag(df, r, s)).alias(f"c{i}") for i, (r, s) in enumerate(listed)),
        ).first()
        rows = [("*", "any", strategy, row["total"])]
        rows += [
            (r.column, s["detect_method"], strategy, row[f"c{i}"]) for i, (r, s) in enumerate(listed)
        ]
        return df.sparkSession.createDataFrame(
            rows, "column string, method string, strategy string, outliers long"
        )


class Outliers(Step):
    """Learn all thresholds: one aggregate, one quantile search, and one more of each where a rule
    needs it (median deviation, forest, clipping to the range of normal rows)."""

    model = OutlierModel

    def learns_from_summaries(self) -> bool:
        """Median deviations, forests and own detectors need the rows themselves."""
        return not {r.method for r in self.settings.rules} & {"mad", "isolationforest", "custom"}

    def summary_columns(self, df: DataFrame) -> tuple[list[str], list[str]]:
        return list(dict.fromkeys(r.column for r in self.settings.rules if r.column in df.columns)), []

    def learn(self, df: DataFrame, source=None) -> dict[str, dict]:
        if source is not None and not self.learns_from_summaries():
            raise ValueError("a rule of this step needs the rows, a summary is not enough")
        source = source or RowSource(df)
        rules = [r for r in self.settings.rules if r.column in df.columns]
        unknown = sorted({r.column for r in self.settings.rules} - set(df.columns))
        if unknown:
            warnings.warn(f"columns not in the table: {unknown}", stacklevel=2)
        values = {r.column: finite(df, r.column) for r in rules}
        stats = source.statistics(values, ["n", "mean", "std", "min", "max"])
        wanted: dict[str, list[float]] = {}
        for rule in rules:
            known = wanted.setdefault(rule.column, [])
            known += [s for s in _shares(rule) if s not in known]
        found = source.quantiles({c: (values[c], shares) for c, shares in wanted.items()}, stats)
        at = {c: dict(zip(shares, found[c], strict=True)) for c, shares in wanted.items()}
        spread = self._median_deviations(df, rules, values, stats, at)

        state: dict[str, dict] = {c: {"rules": []} for c in values}
        for rule in rules:
            state[rule.column]["rules"].append(
                self._learned(df, rule, values, stats[rule.column], at.get(rule.column, {}), spread)
            )
        self._bounds_of_normal_rows(df, rules, values, state)
        return state

    @staticmethod
    def _median_deviations(df, rules, values, stats, at) -> dict[str, float]:
        columns = {r.column for r in rules if r.method == "mad" and stats[r.column]["n"]}
        gaps = {c: F.abs(values[c] - F.lit(at[c][0.5])) for c in sorted(columns)}
        found = quantiles(df, {c: (gap, [0.5]) for c, gap in gaps.items()})
        return {c: found[c][0] for c in gaps}

    def _learned(self, df, rule: OutlierRule, values, stats: dict, at: dict, spread: dict) -> dict:
        x, method = values[rule.column], rule.method
        learned = {"detect_method": method, "handle_method": rule.handle, "threshold": rule.threshold}
        learned |= {k: stats[k] for k in ("mean", "std", "min", "max")}
        learned["median"] = at.get(0.5)
        needed = {"iqr": 4, "custom": 0, "minmax_business": 0}.get(method, 2)
        if method not in ("custom", "minmax_business") and stats["min"] == stats["max"]:
            learned["detect_method"] = NOTHING
        elif method == "custom" and not _works(df, rule, number(df, rule.column)):
            learned["detect_method"] = NOTHING
        elif stats["n"] < needed:
            learned["detect_method"] = NOTHING
        elif method == "zscore":
            reach = rule.threshold * stats["std"]
            learned |= {"lower_bound": stats["mean"] - reach, "upper_bound": stats["mean"] + reach}
        elif method == "iqr":
            reach = rule.threshold * (at[0.75] - at[0.25])
            learned |= {"lower_bound": at[0.25] - reach, "upper_bound": at[0.75] + reach}
        elif method == "robust":
            low, high = (at[q / 100] for q in rule.quantile_range)
            learned |= {"lower_bound": low, "upper_bound": high}
        elif method == "mad":
            limit = 3.0 if rule.threshold is None else rule.threshold
            learned |= {"mad": spread[rule.column], "threshold": limit}
            if learned["mad"] == 0:
                learned["detect_method"] = NOTHING
            else:
                reach = limit * learned["mad"] / MAD_TO_DEVIATION
                learned |= {"lower_bound": at[0.5] - reach, "upper_bound": at[0.5] + reach}
        elif method == "minmax_business":
            low, high = rule.feature_range_business
            learned |= {"lower_bound": float(low), "upper_bound": float(high)}
        elif method == "isolationforest":
            row_id = col(self.settings.row_id) if self.settings.row_id else None
            learned["contamination"] = rule.contamination
            learned["ranges"] = anomalous_ranges(
                df, x, stats["n"], rule.contamination, rule.random_state, row_id, rule.trees, rule.tree_rows
            )
        return learned

    @staticmethod
    def _bounds_of_normal_rows(df, rules, values, state) -> None:
        """Clipping without natural bounds goes to the smallest and largest unflagged value."""
        places: dict[str, int] = {}
        open_rules = []
        for rule in rules:
            place = places.get(rule.column, 0)
            places[rule.column] = place + 1
            learned = state[rule.column]["rules"][place]
            if rule.handle == "clip" and learned["detect_method"] in ("custom", "isolationforest"):
                open_rules.append((rule, learned))
        if not open_rules:
            return
        aggregates = []
        for i, (rule, learned) in enumerate(open_rules):
            normal = F.when(~OutlierModel._flag(df, rule, learned), values[rule.column])
            aggregates += [F.min(normal).alias(f"l{i}"), F.max(normal).alias(f"h{i}")]
        row = df.agg(*aggregates).first()
        for i, (_, learned) in enumerate(open_rules):
            learned |= {"lower_bound": row[f"l{i}"], "upper_bound": row[f"h{i}"]}
