"""Sharding by rendezvous hashing of record keys over weighted shards, with built-in functions only.

Every shard draws ``weight / -ln(u)`` for a key, where ``u`` in (0, 1) comes from a hash of the key and
the number of the shard; the largest draw wins. A draw depends on nothing but key, shard and weight,
so one more shard takes rows into itself and moves no other row.

Slots number the rows of a shard without a gap. Equal rows are counted before the shuffle, each shard
is cut into buckets by a hash, rows are ranked within a bucket, and the buckets of a shard start where
the ones before them end. The number of buckets follows the number of rows, so no task gets a shard.

Defined results: a null key is a key like any other; rows with equal keys share a shard; repeated rows
get slots of their own; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import col, fresh

#: Rows of one shard that are ranked together.
ROWS_PER_BUCKET = 20_000
#: Copies of one row that are numbered by one step.
COPIES_PER_STEP = 4_096


def draw(key: Column, shard: int, weight: float) -> Column:
    """The draw of one shard for a key; 52 bits of the hash keep ``u`` strictly between 0 and 1."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12).cast("double")
    return F.lit(float(weight)) / -F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 52)))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard of a key: the number of the largest draw, the larger number among equal draws."""
    if not weights or min(weights) <= 0:
        raise ValueError("give a positive weight for every shard")
    text = F.coalesce(key.cast("string"), F.lit("\0null"))
    draws = [F.struct(draw(text, i, w).alias("d"), F.lit(i).alias("i")) for i, w in enumerate(weights)]
    return F.array_max(F.array(*draws))["i"]


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; a null text counts 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(1)


def text_crc32(text: Column) -> Column:
    """CRC-32 of the UTF-8 bytes, unsigned; a null text counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def assign(df: DataFrame, key: str, weights: list[float], shard: str = "shard", grown_shard: str | None = None,
           grown_weight: float = 1.0) -> DataFrame:
    """Add the shard of every row and, if named, its shard once there is one shard more."""
    out = df.withColumn(shard, rendezvous(col(key), weights))
    if grown_shard:
        out = out.withColumn(grown_shard, rendezvous(col(key), [*weights, grown_weight]))
    return out


def number_slots(df: DataFrame, shard: str = "shard", slot: str = "slot", rows_per_bucket: int = ROWS_PER_BUCKET,
                 ) -> DataFrame:
    """Add a number to every row, gapless from 0 within its shard; the order follows the row's values.

    The columns must be ones that can be grouped (no maps).
    """
    kept = [c for c in df.columns if c != slot]
    bucket, copies, rank, first = (fresh(df, n) for n in ("bucket", "copies", "rank", "first"))
    rows = df.count()
    buckets = max(1, rows // rows_per_bucket)
    counted = (
        df.groupBy(*map(col, kept)).agg(F.count("*").alias(copies))
        .withColumn(bucket, F.pmod(F.xxhash64(*map(col, kept)), F.lit(buckets)))
    )
    in_bucket = Window.partitionBy(col(shard), bucket).orderBy(*map(col, kept))
    ranked = counted.withColumn(rank, F.sum(copies).over(in_bucket.rowsBetween(Window.unboundedPreceding, -1)))
    sizes = counted.groupBy(col(shard).alias("of_shard"), F.col(bucket).alias("of_bucket")).agg(
        F.sum(copies).alias("rows"))
    earlier = Window.partitionBy("of_shard").orderBy("of_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("of_shard", "of_bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(first))
    placed = ranked.join(starts, col(shard).eqNullSafe(F.col("of_shard")) & (F.col(bucket) == F.col("of_bucket")))
    start = F.col(first) + F.coalesce(F.col(rank), F.lit(0))
    steps = F.sequence(F.lit(0).cast("long"), F.expr(f"(`{copies}` - 1) div {COPIES_PER_STEP}"))
    stepped = placed.select(*map(col, kept), start.alias(first), copies, F.explode(steps).alias(rank))
    end = F.least(F.col(copies), (F.col(rank) + 1) * F.lit(COPIES_PER_STEP)) - 1
    each = F.explode(F.sequence(F.col(rank) * F.lit(COPIES_PER_STEP), end)).alias(rank)
    return stepped.select(*map(col, kept), first, each).select(
        *map(col, kept), (F.col(first) + F.col(rank)).alias(slot)
    )
