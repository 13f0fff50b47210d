"""Stateful stream steps: time buckets without gaps, and rows without copies.

Both keep their state only as far as the watermark needs it, and say what they do with late rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.columns import col, number, type_of
from millrace.operators.sampling import AGGREGATIONS, frequency_seconds

#: Per bucket and column: count, mean, sum of squared distances from it, least, largest.
_CELLS = 5


def _summed(values: pd.Series) -> list[float]:
    held = values.dropna()
    if not len(held):
        return [0.0, 0.0, 0.0, math.inf, -math.inf]
    mean = float(held.mean())
    return [float(len(held)), mean, float(((held - mean) ** 2).sum()), float(held.min()), float(held.max())]


def _joined(a: list[float], b: list[float]) -> list[float]:
    n = a[0] + b[0]
    if not a[0] or not b[0]:
        return a if a[0] else b
    away = b[1] - a[1]
    return [n, a[1] + away * b[0] / n, a[2] + b[2] + away * away * a[0] * b[0] / n, min(a[3], b[3]), max(a[4], b[4])]


def _result(cell: list[float], how: str) -> float | None:
    n, mean, squares, least, largest = cell
    if how == "count":
        return n
    if not n:
        return 0.0 if how == "sum" else None
    return {"mean": mean, "sum": mean * n, "min": least, "max": largest, "std": math.sqrt(squares / (n - 1)) if n > 1 else None}[how]


def gap_filled_stream(
    stream: DataFrame, time: str, freq: str, aggregation: dict[str, str], late: str, by: list[str] = (), idle_buckets: int | None = None
) -> DataFrame:
    """``by``, bucket start and aggregates of every bucket from a series' first one on, empty ones included.

    A bucket is given out once the watermark has passed its end: those with rows when they close, empty ones by a
    timer, so that a silent series goes on. Empty buckets have 0 for sums and counts and NULL for everything else. With
    ``idle_buckets`` a series pauses after so many empty ones; its next row fills the gap at once. ``time`` must be
    a TIMESTAMP; rows later than ``late`` are dropped by Spark. The state of a series is its open buckets and
    one number, so it grows with lateness, not with the stream.
    """
    seconds, by = frequency_seconds(freq), list(by)
    if 86_400 % seconds:
        raise ValueError("on a stream the frequency must divide a day")
    unknown = sorted(set(aggregation.values()) - set(AGGREGATIONS))
    if unknown or not aggregation:
        raise ValueError(f"unknown aggregation {unknown}; use one of {list(AGGREGATIONS)}")
    step, columns, kinds = seconds * 1_000_000, list(aggregation), list(aggregation.values())
    keys = [F.col(f"k{i}") for i in range(len(by))] or [F.col("k")]
    rows = stream.withWatermark(time, late).where(col(time).isNotNull()).select(
        *(col(c).alias(f"k{i}") for i, c in enumerate(by)), *([] if by else [F.lit(0).alias("k")]), col(time).alias("time"),
        F.unix_micros(col(time)).alias("at"), *(number(stream, c).alias(f"v{i}") for i, c in enumerate(columns)))
    width = len(columns) * _CELLS

    def work(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        following, starts, cells = state.get if state.exists else (None, [], [])
        buckets = {s: list(cells[i * width : (i + 1) * width]) for i, s in enumerate(starts)}
        for batch in batches:
            for start, part in batch.groupby(batch["at"] - batch["at"] % step):
                found = [x for i in range(len(columns)) for x in _summed(part[f"v{i}"])]
                held = buckets.get(int(start))
                buckets[int(start)] = found if held is None else [
                    x for i in range(0, width, _CELLS) for x in _joined(held[i : i + _CELLS], found[i : i + _CELLS])]
        closed = state.getCurrentWatermarkMs() * 1000  # buckets that end up to here are complete
        if following is None and buckets:
            following = min(buckets)
        out, empty = [], 0
        blank = [0.0, 0.0, 0.0, math.inf, -math.inf] * len(columns)
        latest = max(buckets, default=None)
        while following is not None and following + step <= closed:
            if following not in buckets and idle_buckets is not None and (latest is None or following > latest):
                if empty >= idle_buckets or state.hasTimedOut and idle_buckets == 0:
                    break
                empty += 1
            cell = buckets.pop(following, blank)
            out.append((*key, following, *(_result(cell[i * _CELLS : (i + 1) * _CELLS], how) for i, how in enumerate(kinds))))
            following += step
        places = sorted(buckets)
        state.update((following, places, [x for p in places for x in buckets[p]]))
        waits = places[0] if places else following if idle_buckets is None else None
        if waits is not None:
            state.setTimeoutTimestamp(max(waits + step, closed + 1000) // 1000)
        yield pd.DataFrame(out, columns=names)

    names = [*(f"k{i}" for i in range(len(by) or 1)), "start", *(f"v{i}" for i in range(len(columns)))]
    key_types = [type_of(stream, c) for c in by] or [T.IntegerType()]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, [*key_types, T.LongType(), *[T.DoubleType()] * len(columns)], strict=True)])
    kept = T.StructType([T.StructField("following", T.LongType()), T.StructField("starts", T.ArrayType(T.LongType())),
                         T.StructField("cells", T.ArrayType(T.DoubleType()))])
    filled = rows.groupBy(*keys).applyInPandasWithState(work, schema, kept, "append", GroupStateTimeout.EventTimeTimeout)
    return filled.select(
        *(F.col(f"k{i}").alias(c) for i, c in enumerate(by)), F.timestamp_micros("start").alias(time),
        *(F.col(f"v{i}").cast("long" if how == "count" else "double").alias(c) for i, (c, how) in enumerate(aggregation.items())))


def dedup_stream(stream: DataFrame, time: str, horizon: str, columns: list[str] | None = None) -> DataFrame:
    """Rows whose ``columns`` (all of them, if not given) were not seen before within the horizon.

    State holds two 64-bit hashes per distinct row and goes away once the watermark, ``horizon`` behind the latest
    time, has passed the row's. Missing values equal missing values. Rows later than the horizon are dropped, not
    compared; :class:`LateRows` counts them.
    """
    keys = [col(c) for c in (columns or stream.columns)]
    # a missing value and its neighbour's value must not change places unnoticed: hash which values are missing too
    shape = F.concat_ws("", *(k.isNull().cast("int").cast("string") for k in keys))
    hashed = stream.withWatermark(time, horizon).withColumn("__hash_a", F.xxhash64(shape, *keys)).withColumn(
        "__hash_b", F.xxhash64(F.lit("b"), *reversed(keys), shape))
    return hashed.dropDuplicatesWithinWatermark(["__hash_a", "__hash_b"]).drop("__hash_a", "__hash_b")


class LateRows(StreamingQueryListener):
    """Counts rows that stateful steps dropped because they came behind the watermark, by query name or id."""

    def __init__(self):
        self.counts: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.counts.setdefault(event.name or str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        name = progress.name or str(progress.id)
        dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        self.counts[name] = self.counts.get(name, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over all that its source holds now, and read what it wrote."""
    spark: SparkSession = stream.sparkSession
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
