"""Missing values: fixed rules per column, a choice by shape for the rest, and indicators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import (
    col, number, numeric_columns, present, text_columns, type_of, without_nan,
)
from millrace.operators.base import Fitted, Step
from millrace.plans.order import carry_fill
from millrace.plans.sources import RowSource

FILLS = ("constant", "mean", "median", "mode", "ffill", "bfill")
INDICATOR = "_missing_indicator"


@dataclass(frozen=True)
class FillSettings:
    """``rules`` maps a column to a fill; ``constants`` holds the values of constant fills.

    ``smart`` fills the remaining columns: the mean for a numeric column with |skewness| up to
    ``skew_limit``, the median beyond it, the mode for text. Columns with a larger share of missing
    values than ``smart_limit`` are then left alone. ``important`` columns, and columns missing more
    than ``high_share``, get an indicator if they have missing values at all. ``time`` and ``row_id``
    give the order that ``ffill`` and ``bfill`` follow.
    """

    rules: dict[str, str] = field(default_factory=dict)
    constants: dict[str, object] = field(default_factory=dict)
    skip: tuple[str, ...] = ()
    smart: bool = False
    important: tuple[str, ...] = ()
    skew_limit: float = 1.0
    smart_limit: float = 1.0
    high_share: float = 0.3
    time: str | None = None
    row_id: str | None = None

    def __post_init__(self):
        if not self.rules and not self.smart:
            raise ValueError("give fill rules, or switch the smart fill on")
        unknown = sorted(set(self.rules.values()) - set(FILLS))
        if unknown:
            raise ValueError(f"unknown fill {unknown}; use one of {FILLS}")
        both = sorted(set(self.rules) & set(self.skip))
        if both:
            raise ValueError(f"columns both filled and skipped: {both}")
        unset = [c for c, how in self.rules.items() if how == "constant" and c not in self.constants]
        if unset:
            raise ValueError(f"constant fills without a value: {unset}")
        if {"ffill", "bfill"} & set(self.rules.values()) and not (self.time and self.row_id):
            raise ValueError("ffill and bfill need time and row_id")

    @classmethod
    def from_dict(cls, config: dict, **order) -> "FillSettings":
        """Read ``{"spec_fill": [{fill: {columns, fill_value}}], "skip_fill": …, …}``."""
        rules, constants = {}, {}
        for entry in config.get("spec_fill", []):
            for how, options in entry.items():
                for i, c in enumerate(options.get("columns", [])):
                    if c in rules:
                        raise ValueError(f"{c} has two fills")
                    rules[c] = how
                    if how == "constant":
                        constants[c] = options["fill_value"][i]
        return cls(
            rules=rules,
            constants=constants,
            skip=tuple(config.get("skip_fill", ())),
            smart=bool(config.get("smart_fill_remain", False)),
            important=tuple(config.get("important_columns", ())),
            **order,
        )


class FillModel(Fitted):
    """``state[column]``: the fill, its value, and the share of missing values in training."""

    def _column_order(self, df: DataFrame, how: str) -> list[str]:
        return [c for c in present(df, self.state) if self.state[c]["fill"] == how]

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        made = {}
        for name in present(df, self.state):
            s, value = self.state[name], without_nan(df, name)
            if s["indicator"]:
                made[name + INDICATOR] = value.isNull().cast("tinyint")
            if s["fill"] in FILLS[:4] and s["value"] is not None:
                fill = F.lit(s["value"])
                made[name] = F.coalesce(value, fill.cast(type_of(df, name)) if s["fill"] == "mode" else fill)
        return made

    def _transform(self, df: DataFrame) -> DataFrame:
        df = super()._transform(df)
        ahead, back = self._column_order(df, "ffill"), self._column_order(df, "bfill")
        if not ahead and not back:
            return df
        clean = df.withColumns({c: without_nan(df, c) for c in [*ahead, *back]})
        filled = carry_fill(clean, ahead, back, self.settings.time, self.settings.row_id)
        return filled.select(*(col(c) for c in df.columns))

    @property
    def missing_indicator(self) -> list[str]:
        """Columns watched for missing values: the important ones and those missing often.

        A complete column may be listed; it gets no indicator column.
        """
        return [c for c, s in self.state.items() if s["watched"]]


class FillMissing(Step):
    """One aggregate counts missing values and takes means and skewness; quantiles and modes follow
    only for the columns that use them."""

    model = FillModel

    def learns_from_summaries(self) -> bool:
        return True

    def summary_columns(self, df: DataFrame) -> tuple[list[str], list[str]]:
        s = self.settings
        numbers = [c for c in numeric_columns(df) if c not in (s.row_id, s.time)]
        texts = [c for c in text_columns(df) if c != s.time]
        return numbers, [*texts, *(c for c in numbers if s.rules.get(c) == "mode")]

    def learn(self, df: DataFrame, source=None) -> dict[str, dict]:
        s, source = self.settings, source or RowSource(df)
        numbers = [c for c in numeric_columns(df) if c not in (s.row_id, s.time)]
        texts = [c for c in text_columns(df) if c != s.time]
        stats = source.statistics({c: number(df, c) for c in numbers}, ["n", "mean", "skew", "min", "max"], finite_only=False)
        counted = source.statistics({c: col(c) for c in texts}, ["n"], finite_only=False)
        filled = {c: s.rules.get(c) for c in [*numbers, *texts] if c not in s.skip}
        gaps = {}
        for c in filled:
            known = stats[c] if c in stats else counted[c]
            gaps[c] = 1 - known["n"] / known["rows"] if known["rows"] else 0.0
            if filled[c] is None and s.smart and 0 < gaps[c] <= s.smart_limit:
                skew = stats[c]["skew"] if c in stats else None
                near = skew is None or abs(skew) <= s.skew_limit
                filled[c] = "mode" if c in texts else ("mean" if near else "median")

        def using(how: str, among: list[str]) -> list[str]:
            return [c for c in among if filled.get(c) == how]

        medians = source.quantiles({c: (number(df, c), [0.5]) for c in using("median", numbers)}, stats)
        values: dict[str, object] = {c: m[0] for c, m in medians.items()}
        values |= {c: stats[c]["mean"] for c in using("mean", numbers)}
        whole = [c for c in using("mode", numbers) if isinstance(type_of(df, c), T.IntegralType)]
        values |= {c: None if v is None else int(v) for c, v in source.modes(whole, "decimal(20,0)").items()}
        values |= source.modes([c for c in using("mode", numbers) if c not in whole], "double")
        values |= source.modes(using("mode", texts))
        values |= {c: v for c, v in s.constants.items() if filled.get(c) == "constant"}
        return {
            c: {
                "fill": how or "none",
                "value": values.get(c),
                "share": gaps[c],
                "watched": c in s.important or gaps[c] > s.high_share,
                "indicator": gaps[c] > 0 and (c in s.important or gaps[c] > s.high_share),
            }
            for c, how in filled.items()
        }
