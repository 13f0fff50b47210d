"""Exogenous series beside a table: the latest value at or before a row's time, and the intervals that hold it.

Neither join brings all rows of a key into one task. The as-of join puts both tables in one order of
``(key, time)``, cut into ranges wherever they are full, and carries one value per range through the
driver. The interval join is an equi-join on slices of time: an interval is entered in up to
``SLICES`` + 1 slices of the width that suits its length, a row asks for the slice of each width in use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, epoch_micros, type_of
from millrace.plans.order import BUCKET, entity_ranges, from_earlier_ranges, last_before

#: Slices that an interval covers at most, but for one; widths grow by this factor.
SLICES = 16
FINEST_MICROS = 1_000_000
WIDTHS = 10


def _key(df: DataFrame, keys: list[str]) -> Column:
    return F.struct(*(col(k) for k in keys)) if keys else F.struct(F.lit(0).alias("all"))


def asof_attach(
    df: DataFrame, series: DataFrame, time: str, columns: list[str], by: list[str] = (), series_time: str | None = None,
    tie: str | None = None, tolerance_seconds: float | None = None, exact: bool = True, prefix: str = "", parts: int | None = None,
) -> DataFrame:
    """The table with the series' ``columns`` at the latest time not after the row's, of equal ``by`` columns.

    Without ``exact`` the series' row must be earlier. Among series rows of one instant the one of the largest
    ``tie`` counts, else any. A row that finds nothing, nothing within ``tolerance_seconds``, or has no time, gets
    NULLs; series rows without time are not found. Missing keys equal missing keys. Added names get the prefix.
    """
    series_time, by = series_time or time, list(by)
    names = [prefix + c for c in columns]
    both = sorted({n.lower() for n in names} & {c.lower() for c in df.columns})
    if both:
        raise ValueError(f"columns in both tables: {both}; give a prefix")
    tie_column = col(tie) if tie else F.lit(None).cast("int")
    found = T.StructType([T.StructField("at", T.LongType()), *(T.StructField(f"v{i}", type_of(series, c)) for i, c in enumerate(columns))])
    row_type = df.schema
    asks = df.select(
        _key(df, by).alias("key"), epoch_micros(df, time).alias("at"), F.lit(1 if exact else 0).alias("turn"), F.lit(None).cast(type_of(series, tie) if tie else "int").alias("tie"),
        F.monotonically_increasing_id().alias("spread"), F.struct(*(col(c) for c in df.columns)).alias("row"), F.lit(None).cast(found).alias("value"))
    moment = epoch_micros(series, series_time)
    events = series.where(moment.isNotNull()).select(
        _key(series, by).alias("key"), moment.alias("at"), F.lit(0 if exact else 1).alias("turn"), tie_column.alias("tie"),
        F.monotonically_increasing_id().alias("spread"), F.lit(None).cast(row_type).alias("row"),
        F.struct(moment.alias("at"), *(col(c).alias(f"v{i}") for i, c in enumerate(columns))).cast(found).alias("value"))
    order = [F.col(c) for c in ("at", "turn", "tie", "spread")]
    dealt = entity_ranges(asks.union(events), "key", order, parts)
    carried = last_before(dealt, "key", F.struct(*order), F.col("value"), found)
    grown = Window.partitionBy(BUCKET, "key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = F.last("value", ignorenulls=True).over(grown)
    joined = dealt.join(carried, BUCKET).withColumn("hit", F.coalesce(own, from_earlier_ranges("key"))).where("row is not null")
    near = F.col("at").isNotNull()
    if tolerance_seconds is not None:
        near = near & (F.col("at") - F.col("hit.at") <= F.lit(int(tolerance_seconds * 1_000_000)))
    added = [F.when(near, F.col(f"hit.v{i}")).alias(n) for i, n in enumerate(names)]
    return joined.select(*(F.col("row").getField(c).alias(c) for c in df.columns), *added)


def _width(level: Column) -> Column:
    return F.lit(FINEST_MICROS) * F.pow(F.lit(float(SLICES)), level).cast("long")


def interval_attach(
    df: DataFrame, intervals: DataFrame, time: str, start: str, end: str, columns: list[str], by: list[str] = (),
    how: str = "inner", prefix: str = "",
) -> DataFrame:
    """Each row with the ``columns`` of every interval ``start <= time < end`` of equal ``by`` columns.

    A missing start or end is open. ``how`` may be ``inner`` or ``left``. Intervals that end before they start hold
    nothing, missing keys equal missing keys, and rows without time are in no interval.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    by, names = list(by), [prefix + c for c in columns]
    both = sorted({n.lower() for n in names} & {c.lower() for c in df.columns})
    if both:
        raise ValueError(f"columns in both tables: {both}; give a prefix")
    rows = df.select(F.struct(*(col(c) for c in df.columns)).alias("row"), _key(df, by).alias("key"), epoch_micros(df, time).alias("at"))
    span = rows.agg(F.min("at").alias("low"), F.max("at").alias("high")).first()
    low, high = (0, 0) if span["low"] is None else (span["low"], span["high"])
    ends = intervals.select(
        F.greatest(F.coalesce(epoch_micros(intervals, start), F.lit(low)), F.lit(low)).alias("a"),
        F.least(F.coalesce(epoch_micros(intervals, end), F.lit(high + 1)), F.lit(high + 1)).alias("b"),
        _key(intervals, by).alias("of"), *(col(c).alias(f"v{i}") for i, c in enumerate(columns))).where("a < b")
    level, length = F.lit(WIDTHS), F.col("b") - F.col("a")
    for i in reversed(range(WIDTHS)):
        level = F.when(length <= FINEST_MICROS * SLICES ** (i + 1), i).otherwise(level)
    leveled = ends.withColumn("level", level.cast("int"))
    used = [r["level"] for r in leveled.select("level").distinct().collect()]  # at most as many as there are widths
    first, last = F.floor(F.col("a") / _width(F.col("level"))), F.floor((F.col("b") - 1) / _width(F.col("level")))
    entered = leveled.withColumn("slice", F.explode(F.sequence(first, last)))
    asked = rows.where("at is not null").withColumn("asked", F.explode(F.array(*map(F.lit, used)).cast("array<int>")))
    asked = asked.withColumn("place", F.floor(F.col("at") / _width(F.col("asked"))))
    met = asked.join(entered, F.col("key").eqNullSafe(F.col("of")) & (F.col("asked") == F.col("level")) & (F.col("place") == F.col("slice"))
                     & (F.col("a") <= F.col("at")) & (F.col("at") < F.col("b")))
    kept = [F.col("row").getField(c).alias(c) for c in df.columns]
    pairs = met.select(*kept, *(F.col(f"v{i}").alias(n) for i, n in enumerate(names)))
    if how == "inner":
        return pairs
    # rows in no interval: those whose key and instant have none, whatever else they hold
    hit = met.select(F.col("key").alias("hit_key"), F.col("at").alias("hit_at")).distinct()
    alone = rows.join(hit, F.col("key").eqNullSafe(F.col("hit_key")) & (F.col("at") == F.col("hit_at")), "left_anti")
    blank = [F.lit(None).cast(type_of(intervals, c)).alias(n) for c, n in zip(columns, names, strict=True)]
    return pairs.unionByName(alone.select(*kept, *blank))
