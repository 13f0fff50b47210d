"""Every n-th row, and resampling to a coarser time grid."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import (
    col, epoch_micros, from_epoch_micros, type_of, without_nan,
)
from millrace.plans.order import with_position


@dataclass(frozen=True)
class SystematicSample:
    """Rows at positions ``start_index, start_index + step, …`` of the order ``(time, row_id)``.

    ``pos`` is the position in the input, or counts 0, 1, 2, … with ``reset_index``.
    """

    start_index: int = 0
    step: int = 1
    reset_index: bool = False

    def __post_init__(self):
        for name in ("start_index", "step"):
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, int):
                raise TypeError(f"{name} must be an integer")
        if self.start_index < 0:
            raise ValueError("start_index must not be negative")
        if self.step < 1:
            raise ValueError("step must be at least 1")

    def apply(self, df: DataFrame, time: str, row_id: str, buckets: int | None = None) -> DataFrame:
        offset = F.col("pos") - F.lit(self.start_index)
        kept = with_position(df, time, row_id, "pos", buckets).where(
            (offset >= 0) & (F.pmod(offset, F.lit(self.step)) == 0)
        )
        if self.reset_index:
            kept = kept.withColumn("pos", F.floor(offset / F.lit(self.step)).cast("long"))
        return kept


# Frequency letters and their length in seconds.
UNIT_SECONDS = {"S": 1, "T": 60, "MIN": 60, "M": 60, "H": 3600, "D": 86_400, "W": 604_800}


def frequency_seconds(freq: str) -> int:
    """Seconds of a frequency such as ``"3H"``, ``"15min"`` or ``"D"``."""
    match = re.fullmatch(r"(\d*)\s*([A-Za-z]+)", str(freq).strip())
    unit = match.group(2).upper() if match else ""
    if unit not in UNIT_SECONDS or (match.group(1) and int(match.group(1)) == 0):
        raise ValueError(f"unknown frequency {freq!r}; use a number and one of {list(UNIT_SECONDS)}")
    return int(match.group(1) or 1) * UNIT_SECONDS[unit]


AGGREGATIONS = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev_samp,
}


@dataclass(frozen=True)
class TimeResample:
    """One row per time bucket, named by the bucket's start.

    ``aggregation`` is one name for all numeric columns or a name per column; the label may have its
    own. Buckets start at midnight of the first day, as calendar grids do. Empty buckets are left
    out unless ``keep_empty``, which gives 0 for sums and counts and NULL for everything else.
    """

    time_column: str
    freq: str
    aggregation: str | dict[str, str] = "mean"
    label: str | None = None
    label_aggregation: str | None = None
    keep_empty: bool = False

    def _plan(self, df: DataFrame) -> dict[str, str]:
        if isinstance(self.aggregation, dict):
            plan = {c: a for c, a in self.aggregation.items() if c in df.columns}
        else:
            plan = {
                f.name: self.aggregation
                for f in df.schema.fields
                if isinstance(f.dataType, T.NumericType) and f.name != self.time_column
            }
        if self.label and self.label in df.columns:
            plan[self.label] = self.label_aggregation or plan.get(self.label, "mean")
        unknown = sorted({a for a in plan.values() if a not in AGGREGATIONS})
        if unknown:
            raise ValueError(f"unknown aggregation {unknown}; use one of {list(AGGREGATIONS)}")
        return plan

    def apply(self, df: DataFrame) -> DataFrame:
        if self.time_column not in df.columns:
            return df
        seconds, plan = frequency_seconds(self.freq), self._plan(df)
        time, offset = col(self.time_column), None
        if 86_400 % seconds:
            first = df.agg(F.min(epoch_micros(df, self.time_column)).alias("t")).first()["t"]
            offset = 0 if first is None else (first // 86_400_000_000 * 86_400) % seconds
        bucket = F.window(time, f"{seconds} seconds", startTime=f"{offset} seconds" if offset else None)
        grid = (
            df.groupBy(bucket.alias("__window"))
            .agg(*(AGGREGATIONS[a](without_nan(df, c)).alias(c) for c, a in plan.items()))
            .select(
                F.col("__window.start").alias(self.time_column), *(col(c) for c in plan)
            )
        )
        if self.keep_empty:
            grid = self._fill_gaps(df, grid, plan, seconds)
        return grid.orderBy(col(self.time_column))

    def _fill_gaps(self, df: DataFrame, grid: DataFrame, plan: dict, seconds: int) -> DataFrame:
        """Left join to a spine of all buckets, which executors generate from a range of numbers."""
        step = seconds * 1_000_000
        micros = epoch_micros(grid, self.time_column)
        ends = grid.agg(F.min(micros).alias("low"), F.max(micros).alias("high")).first()
        if ends["low"] is None:
            return grid
        numbers = df.sparkSession.range((ends["high"] - ends["low"]) // step + 1)
        spine = numbers.select((F.lit(ends["low"]) + F.col("id") * step).alias("__micros"))
        joined = spine.join(grid.withColumn("__micros", micros), "__micros", "left")
        start = from_epoch_micros(F.col("__micros"), type_of(grid, self.time_column))
        columns = [
            F.coalesce(col(c), F.lit(0)).alias(c) if a in ("sum", "count") else col(c)
            for c, a in plan.items()
        ]
        return joined.select(start.alias(self.time_column), *columns)
