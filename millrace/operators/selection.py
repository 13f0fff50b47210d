"""Keep the columns that go with the label."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import (
    col, epoch_micros, number, numeric_columns, text_columns, time_columns,
)
from millrace.operators.base import Fitted, Step
from millrace.plans.statistics import correlation


@dataclass(frozen=True)
class SelectSettings:
    """``label=None`` keeps everything; ``keep`` columns always stay."""

    label: str | None
    threshold: float = 0.0
    keep: tuple[str, ...] = ()


class SelectModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        dropped = {c for c, s in self.state.items() if not s["kept"]}
        return df.select(*(col(c) for c in df.columns if c not in dropped))


class SelectByCorrelation(Step):
    """Keep columns whose strength reaches the threshold.

    Strength is |Pearson r| for numbers and times (as epoch), and the correlation ratio for text:
    the share of the label's variance that lies between categories, square-rooted. Numbers take one
    aggregate. Text takes one shuffle of per-category sums for all columns together.
    """

    model = SelectModel

    def learn(self, df: DataFrame) -> dict[str, dict]:
        s = self.settings
        if s.label is None or s.label not in df.columns:
            return {}
        y = number(df, s.label)
        values = {c: number(df, c) for c in numeric_columns(df) if c != s.label}
        values |= {c: epoch_micros(df, c).cast("double") for c in time_columns(df)}
        row = df.agg(
            F.avg(y).alias("mean"),
            *(correlation(v, y).alias(f"c{i}") for i, v in enumerate(values.values())),
        ).first()
        strength = {c: abs(row[f"c{i}"] or 0.0) for i, c in enumerate(values)}
        texts = text_columns(df)
        if texts and row["mean"] is not None:
            strength |= self._ratios(df, texts, y - F.lit(row["mean"]))
        return {
            c: {"strength": v, "kept": v >= s.threshold or c in s.keep} for c, v in strength.items()
        }

    @staticmethod
    def _ratios(df: DataFrame, texts: list[str], centred) -> dict[str, float]:
        cells = [
            F.struct(F.lit(c).alias("column"), col(c).alias("value"), centred.alias("y")) for c in texts
        ]
        groups = (
            df.select(F.inline(F.array(*cells)))
            .where("value is not null and y is not null")
            .groupBy("column", "value")
            .agg(F.count("y").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
        )
        rows = groups.groupBy("column").agg(
            F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between"),
            (F.sum("q") - F.sum("s") * F.sum("s") / F.sum("n")).alias("total"),
            (F.sum("s") * F.sum("s") / F.sum("n")).alias("offset"),
        ).collect()
        found = {
            r["column"]: math.sqrt(max(0.0, (r["between"] - r["offset"]) / r["total"]))
            if r["total"] > 0
            else 0.0
            for r in rows
        }
        return {c: found.get(c, 0.0) for c in texts}
