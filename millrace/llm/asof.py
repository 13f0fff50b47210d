"""The latest earlier event of a key, for many points in time, without all of a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of one slice; a task gets the different instants of one key and slice at a time.
SLICE_SECONDS = 6 * 3600


def latest_earlier(events: DataFrame, asks: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """``key``, ``time`` and ``found``: the value of the key's latest event before the time, strictly.

    ``events`` has ``key``, ``time`` and ``value`` (a struct, or anything that can be ordered); among events of
    one instant the largest value counts. ``asks`` has ``key`` and ``time``. Both are first reduced to one row
    for each key and instant, however many rows share it. Within a slice a window finds the event; what the
    earlier slices of the key end with is carried in by a window over one row for each slice. Null keys equal
    null keys; rows without time find nothing and are not found. Asks without an event get no row.
    """
    slice_of = F.floor(F.unix_micros("time") / F.lit(slice_seconds * 1_000_000))
    once = events.where("time is not null").groupBy("key", "time").agg(F.max("value").alias("value"))
    asked = asks.where("time is not null").select("key", "time").distinct()
    both = once.select("key", "time", F.lit(1).alias("kind"), "value").unionByName(
        asked.select("key", "time", F.lit(0).alias("kind")), allowMissingColumns=True
    ).withColumn("slice", slice_of)
    order = Window.partitionBy("key", "slice").orderBy("time", "kind").rowsBetween(Window.unboundedPreceding, 0)
    within = both.withColumn("own", F.last("value", ignorenulls=True).over(order)).where("kind = 0")
    ends = both.where("kind = 1").groupBy("key", "slice").agg(F.max(F.struct("time", "value"))["value"].alias("value"))
    slices = ends.unionByName(both.where("kind = 0").select("key", "slice").distinct(), allowMissingColumns=True)
    slices = slices.groupBy("key", "slice").agg(F.max("value").alias("value"))
    earlier = Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(
        F.col("key").alias("of_key"), F.col("slice").alias("of_slice"), F.last("value", ignorenulls=True).over(earlier).alias("before")
    ).where("before is not null")
    joined = within.join(carried, F.col("key").eqNullSafe(F.col("of_key")) & (F.col("slice") == F.col("of_slice")), "left")
    return joined.select("key", "time", F.coalesce("own", "before").alias("found")).where("found is not null")
