"""Work that depends on one global row order, without ever sorting the table in one task.

The order is ascending ``(time, row_id)``; ``row_id`` must be unique. ``order_buckets`` cuts it into
contiguous buckets of about equal size at approximate quantiles of the time. An instant that holds
more than a bucket's share of the rows (a default timestamp, say) becomes buckets of its own, cut by
``row_id``. Everything a later step needs from other buckets is one number per bucket, and the
number of buckets is limited by ``MAX_BUCKETS``, so it is summed on the driver and broadcast back. Cuts are doubles, which
only coarsens them: times that share a double share a bucket, and where they are too many their exact
instants are told apart as BIGINT. Missing times come first of all.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, epoch_micros, type_of
from millrace.plans.quantiles import values_at_ranks
from millrace.session import materialize

ROWS_PER_BUCKET = 500_000
MAX_BUCKETS = 8192
CUT_SAMPLE = 500_000
BUCKET = "__bucket"
# Stands for a missing time where one number is needed: before every time that Spark can write.
EARLIEST = -(2**60)


def _cuts(df: DataFrame, key: Column, buckets: int, rows: int) -> list[float]:
    """Approximate quantiles of the key that cut it into buckets.

    They only decide how even the buckets are, never what a result is. A sample of
    ``CUT_SAMPLE`` rows, or a hundred per bucket, keeps the merged sketch small on any number of tasks.
    """
    shares = [i / buckets for i in range(1, buckets)]
    if not shares:
        return []
    sample = max(CUT_SAMPLE, 100 * buckets)
    keys = df.select(key.cast("double").alias("key"))
    if rows > 2 * sample:
        keys = keys.sample(sample / rows, seed=17)
    row = keys.agg(F.percentile_approx("key", shares, max(10_000, 8 * buckets)).alias("cuts")).first()
    return list(row["cuts"] or [])


def _bucketize(df: DataFrame, key: Column, cuts, name: str) -> DataFrame:
    if not cuts:
        return df.withColumn(name, F.lit(0.0))
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    keyed = df.withColumn(f"{name}_key", key.cast("double"))
    cut = Bucketizer(splits=splits, inputCol=f"{name}_key", outputCol=name)
    return cut.transform(keyed).drop(f"{name}_key")


def bucket_count(df: DataFrame, rows: int) -> int:
    # Several buckets per shuffle partition, because hashing spreads few buckets unevenly.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(rows // ROWS_PER_BUCKET, 4 * partitions)
    return max(1, min(MAX_BUCKETS, wanted, rows))


def order_buckets(df: DataFrame, time: str, row_id: str, buckets: int | None = None) -> DataFrame:
    """Add ``__bucket``, a BIGINT that never decreases along ``(time, row_id)``."""
    key = epoch_micros(df, time)
    sizes = df.agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("timed")).first()
    rows, missing = sizes["rows"], sizes["rows"] - sizes["timed"]
    buckets = buckets or bucket_count(df, rows)
    cuts = _cuts(df.where(key.isNotNull()), key, buckets, rows)
    share = max(1.0, rows / max(1, buckets))
    hot = sorted(cut for cut, times in Counter(cuts).items() if times > 1)
    edges = [*cuts, *hot, *(math.nextafter(h, math.inf) for h in hot)]
    coarse = F.when(key.isNull(), F.lit(-1.0)).otherwise(F.col("__time_bucket")).cast("long")
    start = F.coalesce(key.cast("double"), F.lit(float("-inf")))
    keyed = _bucketize(df, start, edges, "__time_bucket")

    # The rows of one double, instant by instant: each instant gets pieces by its number of rows.
    shared = key.isNull() if missing > share else F.lit(False)
    if hot:
        shared = shared | key.cast("double").isin(hot)
    found = []
    if hot or missing > share:
        found = df.where(shared).groupBy(key.alias("instant")).count().collect()
    pieces, taken = [], Counter()
    for row in sorted(found, key=lambda r: (r["instant"] is not None, r["instant"])):
        instant, place = row["instant"], None if row["instant"] is None else float(row["instant"])
        n = math.ceil(row["count"] / share)
        pieces.append((EARLIEST if instant is None else instant, taken[place], n))
        taken[place] += n
    step = 1 + max(taken.values(), default=0)
    if not pieces:
        return keyed.withColumn(BUCKET, coarse * step).drop("__time_bucket")

    id_cuts = _cuts(df.where(shared), col(row_id), buckets, sum(r["count"] for r in found))
    fine = len(set(id_cuts)) + 1
    table = df.sparkSession.createDataFrame(pieces, "__instant long, __offset long, __pieces long")
    keyed = keyed.withColumn("__instant", F.coalesce(key, F.lit(EARLIEST)))
    keyed = keyed.join(F.broadcast(table), "__instant", "left")
    keyed = _bucketize(
        keyed, F.when(F.col("__pieces").isNotNull(), col(row_id)), id_cuts, "__id_bucket"
    )
    piece = F.floor(F.col("__id_bucket") * F.col("__pieces") / F.lit(fine)).cast("long")
    within = F.coalesce(F.col("__offset") + piece, F.lit(0))
    helpers = ["__time_bucket", "__id_bucket", "__instant", "__offset", "__pieces"]
    return keyed.withColumn(BUCKET, coarse * step + within).drop(*helpers)


def _with_lookup(df: DataFrame, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Join one value per bucket; there are at most a few thousand buckets by construction."""
    lookup = df.sparkSession.createDataFrame(rows, schema)
    return df.join(F.broadcast(lookup), BUCKET, "left")


def with_position(
    df: DataFrame, time: str, row_id: str, name: str = "pos", buckets: int | None = None
) -> DataFrame:
    """Add the 0-based position of every row in the global order; one shuffle of the rows."""
    keyed = order_buckets(df, time, row_id, buckets)
    counts = keyed.groupBy(BUCKET).count().collect()
    offsets, start = [], 0
    for bucket, n in sorted((r[BUCKET], r["count"]) for r in counts):
        offsets.append((bucket, start))
        start += n
    schema = T.StructType([T.StructField(BUCKET, T.LongType()), T.StructField("__start", T.LongType())])
    in_order = Window.partitionBy(BUCKET).orderBy(col(time), col(row_id))
    position = F.col("__start") + F.row_number().over(in_order) - F.lit(1)
    return (
        _with_lookup(keyed, offsets, schema).withColumn(name, position).drop(BUCKET, "__start")
    )


def entity_ranges(df: DataFrame, entity: str, order: list[Column], parts: int | None = None) -> DataFrame:
    """The rows dealt out in ranges of ``(entity, order)`` and written, with the number of their range in ``__bucket``.

    Ranges come from Spark's own sample of the keys, so an entity of any size is cut wherever a range is full, and
    only the first entity of a range can have rows in ranges before it. Rows without an entity are one entity.
    """
    if parts is None:
        rows, shuffled = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(1, min(MAX_BUCKETS, rows, max(rows // ROWS_PER_BUCKET, shuffled)))
    return materialize(df.repartitionByRange(parts, col(entity), *order).withColumn(BUCKET, F.spark_partition_id()))


def running_totals(ranges: DataFrame, entity: str, counted: Column) -> DataFrame:
    """``__bucket, __first, __start``: per range its first entity, and the sum of ``counted`` over that entity's rows in
    earlier ranges. The driver gets four values per range, however many entities there are."""
    shares = ranges.groupBy(BUCKET, F.struct(col(entity).alias("e")).alias("e")).agg(F.sum(counted).alias("n"))
    ends = shares.groupBy(BUCKET).agg(F.min(F.struct("e", "n")).alias("first"), F.max(F.struct("e", "n")).alias("last")).collect()
    starts, running, before = [], 0, None
    for row in sorted(ends, key=lambda r: r[BUCKET]):
        first, last = row["first"], row["last"]
        starts.append((row[BUCKET], (first["e"]["e"],), running if first["e"] == before else 0))
        running = last["n"] + (running if first["e"] == last["e"] == before else 0)
        before = last["e"]
    return _by_range(ranges, entity, starts, T.LongType())


def last_before(ranges: DataFrame, entity: str, place: Column, value: Column, value_type: T.DataType) -> DataFrame:
    """``__bucket, __first, __start``: per range its first entity, and the value of that entity's last row in earlier
    ranges that has one; ``place`` orders the rows of an entity."""
    whole = F.struct(col(entity).alias("e"))
    held = F.max_by(F.struct(whole.alias("e"), value.alias("v")), F.when(value.isNotNull(), F.struct(whole, place)))
    ends = ranges.groupBy(BUCKET).agg(F.min(whole).alias("first"), held.alias("last")).collect()
    starts, running = [], None
    for row in sorted(ends, key=lambda r: r[BUCKET]):
        same = running is not None and running["e"] == row["first"]
        starts.append((row[BUCKET], tuple(row["first"]), running["v"] if same else None))
        running = row["last"] or running
    return _by_range(ranges, entity, starts, value_type)


def _by_range(ranges: DataFrame, entity: str, starts: list[tuple], start_type: T.DataType) -> DataFrame:
    schema = T.StructType([
        T.StructField(BUCKET, T.IntegerType()), T.StructField("__first", T.StructType([T.StructField("e", type_of(ranges, entity))])),
        T.StructField("__start", start_type),
    ])
    return F.broadcast(ranges.sparkSession.createDataFrame(starts, schema))


def from_earlier_ranges(entity: str) -> Column:
    """``__start`` for the rows of the first entity of a range, NULL for all others."""
    return F.when(F.col("__first.e").eqNullSafe(col(entity)), F.col("__start"))


def with_entity_position(
    df: DataFrame, entity: str, time: str, row_id: str, name: str = "pos", parts: int | None = None
) -> DataFrame:
    """Add the 0-based position of every row among the rows of its entity, ordered by ``(time, row_id)``."""
    dealt = entity_ranges(df, entity, [col(time), col(row_id)], parts)
    in_order = Window.partitionBy(BUCKET, col(entity)).orderBy(col(time), col(row_id))
    position = F.coalesce(from_earlier_ranges(entity), F.lit(0)) + F.row_number().over(in_order) - F.lit(1)
    joined = dealt.join(running_totals(dealt, entity, F.lit(1)), BUCKET)
    return joined.withColumn(name, position).drop(BUCKET, "__start", "__first")


def carry_fill(
    df: DataFrame,
    forward: list[str],
    backward: list[str],
    time: str,
    row_id: str,
    buckets: int | None = None,
) -> DataFrame:
    """Replace NULLs by the last value before them (``forward`` columns) or the first value after
    them (``backward`` columns) in the global order; one shuffle serves both."""
    keyed = order_buckets(df, time, row_id, buckets)
    order = F.struct(col(time), col(row_id))
    columns = [*forward, *backward]
    picks = [F.max_by] * len(forward) + [F.min_by] * len(backward)
    edges = (
        keyed.groupBy(BUCKET)
        .agg(*(
            pick(col(c), F.when(col(c).isNotNull(), order)).alias(f"e{i}")
            for i, (pick, c) in enumerate(zip(picks, columns, strict=True))
        ))
        .collect()
    )
    carried: dict[int, list] = {row[BUCKET]: [None] * len(columns) for row in edges}
    for i in range(len(columns)):
        nearest = None
        for row in sorted(edges, key=lambda r: r[BUCKET], reverse=i >= len(forward)):
            carried[row[BUCKET]][i] = nearest
            nearest = nearest if row[f"e{i}"] is None else row[f"e{i}"]
    schema = T.StructType(
        [T.StructField(BUCKET, T.LongType())]
        + [T.StructField(f"__c{i}", type_of(df, c)) for i, c in enumerate(columns)]
    )
    # Backward filling walks the reversed order: a frame that only grows costs one step per row,
    # while a frame from the current row to the end is evaluated anew for every row.
    keys = [col(time), col(row_id)]
    grown = (Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(BUCKET).orderBy(*keys).rowsBetween(*grown)
    back = Window.partitionBy(BUCKET).orderBy(*(k.desc() for k in keys)).rowsBetween(*grown)
    frames = [ahead] * len(forward) + [back] * len(backward)
    filled = {
        c: F.coalesce(F.last(col(c), ignorenulls=True).over(frame), F.col(f"__c{i}"))
        for i, (frame, c) in enumerate(zip(frames, columns, strict=True))
    }
    helpers = [BUCKET, *(f"__c{i}" for i in range(len(columns)))]
    rows = [(bucket, *values) for bucket, values in carried.items()]
    return _with_lookup(keyed, rows, schema).withColumns(filled).drop(*helpers)


def steps_in_order(df: DataFrame, order: str, value: str, buckets: int | None = None) -> DataFrame:
    """``step``: each value minus the one before it, in the global order ``(order, value)``."""
    keyed = order_buckets(df, order, value, buckets)
    place = F.struct(col(order), col(value))
    ends = keyed.groupBy(BUCKET).agg(F.max_by(col(value), place).alias("last")).collect()
    lasts = {r[BUCKET]: r["last"] for r in ends}
    places = sorted(lasts)
    before_bucket = [(b, lasts[a]) for a, b in zip(places, places[1:], strict=False)]
    schema = T.StructType([T.StructField(BUCKET, T.LongType()), T.StructField("__before", type_of(df, value))])
    in_order = Window.partitionBy(BUCKET).orderBy(col(order), col(value))
    step = col(value) - F.coalesce(F.lag(col(value)).over(in_order), F.col("__before"))
    return _with_lookup(keyed, before_bucket, schema).select(step.alias("step")).where("step is not null")


@dataclass(frozen=True)
class OrderKey:
    """The ``(time, row_id)`` of one row; ``time`` in microseconds or as plain BIGINT."""

    first: int
    second: int


def keys_at_ranks(
    df: DataFrame, first: Column, second: Column, ranks: list[int], bounds: tuple
) -> dict[int, OrderKey]:
    """The order keys at the given positions, found by counting only: no row is moved.

    ``first`` may repeat; ``second`` then decides, and is unique among equal ``first`` values.
    """
    wanted = sorted(set(ranks))
    firsts = values_at_ranks(
        df, {"first": first}, {"first": wanted}, {"first": bounds}, resolve_ties=True
    )["first"]
    tied = [F.when(first == F.lit(t.value), second) for t in firsts]
    edges = df.where(first.isin([t.value for t in firsts])).agg(
        *(F.min(value).alias(f"l{i}") for i, value in enumerate(tied)),
        *(F.max(value).alias(f"h{i}") for i, value in enumerate(tied)),
    ).first()
    keys = {t.rank: OrderKey(t.value, edges[f"l{i}"]) for i, t in enumerate(firsts) if t.count == 1}
    shared = {str(i): t for i, t in enumerate(firsts) if t.count > 1}
    if shared:
        seconds = values_at_ranks(
            df.where(first.isin([t.value for t in shared.values()])),
            {i: tied[int(i)] for i in shared},
            {i: [t.rank - t.below] for i, t in shared.items()},
            {i: (edges[f"l{i}"], edges[f"h{i}"]) for i in shared},
        )
        keys |= {t.rank: OrderKey(t.value, seconds[i][0].value) for i, t in shared.items()}
    return keys


def before(first: Column, second: Column, key: OrderKey) -> Column:
    """True for rows that come before the key in the order."""
    return (first < F.lit(key.first)) | (
        (first == F.lit(key.first)) & (second < F.lit(key.second))
    )
