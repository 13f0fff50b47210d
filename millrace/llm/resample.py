"""Target-distribution importance resampling: documents that read like a target are drawn more often.

Words and runs of words are hashed into a fixed number of buckets. One pass counts the buckets of all
documents, one those of all target texts; a bucket's gain is the logarithm of how much more frequent it
is in the target. Each text is scored by array code: its bucket numbers select gains, which are summed.
A draw without replacement in proportion to ``exp(weight)`` is the choice of the largest scores after a
random number of the Gumbel distribution is added to each; that number comes from a hash of the key.

The scores are written once. The cutoff is found by numeric bisection: jobs that count the written rows
at or above a threshold, exactly, halve the interval until the score of the last drawn row is known;
the same bisection over the keys of the rows tied there finds the last drawn key. Each job counts the
midpoints of the next ``LEVELS`` halvings at once. Drawn rows are then dealt out by range, and a rank is
the place within its range plus the number of rows before it, one number per range.

Defined results: null texts have no words; texts without features weigh nothing. Null keys draw like an
empty key and come after all others among ties. Rows of equal score and key are drawn one by one. Empty
tables give no rows, an empty target counts nothing. More columns of either table are left alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.fim import draw
from millrace.llm.frames import col, ready_workers
from millrace.session import materialize

#: Halvings whose midpoints are counted in one job.
LEVELS = 4
#: Bytes of one text that are split into words at once.
LONG_TEXT = 1 << 20
#: Rows that one range of drawn rows is meant to hold.
RANGE_ROWS = 1_000_000

#: Bytes of words: digits, lower-cased letters and all bytes beyond ASCII; anything else parts words.
_KEPT = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


@dataclass(frozen=True)
class ResampleSettings:
    """Features are runs of one to ``longest`` words; ``percent`` of the documents with at least
    ``least_words`` words are drawn."""

    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    salt: str = "2024:"

    def __post_init__(self):
        if min(self.longest, self.buckets) < 1 or not 0 <= self.percent <= 100:
            raise ValueError("runs and buckets start at 1, percent lies between 0 and 100")


def word_parts(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in bounded parts; a part ends between two words."""
    content = (text or "").encode("utf-8", "surrogatepass").translate(_KEPT)
    start = 0
    while len(content) - start > LONG_TEXT:
        end = content.find(b" ", start + LONG_TEXT)
        if end < 0:
            break
        yield content[start:end].split()
        start = end
    yield content[start:].split()


def bucket_parts(text: str | None, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Per part of a text: its number of words, and the buckets of all runs that end in it."""
    before: list[bytes] = []
    for words in word_parts(text):
        found = [np.fromiter(map(zlib.crc32, words), np.uint32, len(words))]
        joined = before + words
        for n in range(2, longest + 1):
            runs = joined[max(0, len(before) - n + 1):]
            spans = [b" ".join(runs[i : i + n]) for i in range(len(runs) - n + 1)]
            found.append(np.fromiter(map(zlib.crc32, spans), np.uint32, len(spans)))
        yield len(words), np.concatenate(found).astype(np.int64) % buckets
        before = joined[len(joined) - longest + 1 :] if longest > 1 else []


def bucket_counts(df: DataFrame, text: str, settings: ResampleSettings) -> np.ndarray:
    """How many features of all texts fall into each bucket; every task sends one row per used bucket."""
    ready_workers(df.sparkSession)
    longest, buckets = settings.longest, settings.buckets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in batch.column(0):
                for _, found in bucket_parts(t.as_py(), longest, buckets):
                    total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = df.select(col(text)).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most as many rows as buckets
        total[row["bucket"]] = row["n"]
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the smoothed frequency ratio, rounded down."""
    buckets = len(source)
    s, t = source.sum(), target.sum()
    up = (target + 1.0) * float(s + buckets)
    down = (source + 1.0) * float(t + buckets)
    return np.array([math.floor(1000 * math.log(u / d)) for u, d in zip(up, down, strict=True)], np.int64)


def weigh(df: DataFrame, key: str, text: str, gains: np.ndarray, settings: ResampleSettings) -> DataFrame:
    """``key``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    ready_workers(df.sparkSession)
    longest, buckets = settings.longest, settings.buckets

    def of(texts: pa.Array) -> pa.Array:
        found = []
        for t in texts:
            words = features = weight = 0
            for n, part in bucket_parts(t.as_py(), longest, buckets):
                words, features, weight = words + n, features + len(part), weight + int(gains[part].sum())
            found.append({"n_words": words, "n_features": features, "weight": weight})
        return pa.array(found, pa.struct([(n, pa.int64()) for n in ("n_words", "n_features", "weight")]))

    of.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    scored = df.select(col(key).alias("key"), F.arrow_udf(of, "n_words long, n_features long, weight long")(col(text)).alias("w"))
    return scored.select("key", "w.n_words", "w.n_features", "w.weight")


def gumbel(key: Column, salt: str) -> Column:
    """Thousandths of a Gumbel number drawn from the hash of the key, rounded down."""
    return F.floor(-1000 * F.log(-F.log((draw(key, salt, 0) + 0.5) / 4294967296.0))).cast("long")


def bisect(rows: DataFrame, value: str, wanted: int, low: int, high: int, levels: int = LEVELS) -> tuple[int, int]:
    """The largest whole number ``c`` in ``low … high`` with at least ``wanted`` rows at or above it, and the
    number of rows above it. At least ``wanted`` rows must lie at or above ``low``, none above ``high``.

    Every job counts exactly; it answers ``levels`` halvings at once.
    """
    above = 0  # rows above ``high``, known exactly
    while low < high:
        tree, edges = [(low, high)], []
        for _ in range(levels):
            split = [((a + b + 1) // 2, a, b) for a, b in tree if a < b]
            edges += [m for m, _, _ in split]
            tree = [part for m, a, b in split for part in ((a, m - 1), (m, b))]
        edges = sorted(set(edges))
        counts = rows.where(F.col(value) >= edges[0]).agg(*(F.count_if(F.col(value) >= m).alias(f"c{i}") for i, m in enumerate(edges))).first()
        for i, m in enumerate(edges):
            if counts[i] >= wanted:
                low = m
            else:
                high, above = m - 1, counts[i]
                break
    return low, above


def ranked(drawn: DataFrame, order: list[Column], rows: int, limit: int, rank: str = "rank") -> DataFrame:
    """The rows with their place from 1 in the order, null behind ``limit``: ranges by sampled cuts, and one
    number per range through the driver."""
    spark = drawn.sparkSession
    ranges = max(1, min(rows // RANGE_ROWS + 1, 10_000), min(rows // 1_000, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = materialize(drawn.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()))
    counts = {r["part"]: r["count"] for r in dealt.groupBy("part").count().collect()}
    starts, before = [], 0
    for part in sorted(counts):
        starts.append((part, before))
        before += counts[part]
    offsets = spark.createDataFrame(starts, "part int, before long")
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    placed = dealt.join(F.broadcast(offsets), "part").withColumn(rank, place.cast("long"))
    return placed.withColumn(rank, F.when(F.col(rank) <= limit, F.col(rank))).drop("part", "before")


def resample(df: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             settings: ResampleSettings | None = None) -> DataFrame:
    """Every row's ``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn).

    Keys are whole numbers. Ranks follow falling scores; ties go to the smaller key.
    """
    s = settings or ResampleSettings()
    gains = bucket_gains(bucket_counts(df, text, s), bucket_counts(target, target_text, s))
    scored = weigh(df, key, text, gains, s).withColumn("score", F.col("weight") + gumbel(F.col("key"), s.salt))
    scored = materialize(scored.withColumn("key", F.col("key").cast("long")).withColumn("at", F.monotonically_increasing_id()))
    fit = scored.where(F.col("n_words") >= s.least_words)
    ends = fit.agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    wanted = s.percent * ends["n"] // 100
    columns = ["key", "n_words", "n_features", "weight", "score"]
    if not wanted:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank")).withColumnRenamed("key", key)
    cut, above = bisect(fit, "score", wanted, ends["low"], ends["high"])
    tied = fit.where(F.col("score") == cut).where("key is not null").withColumn("turned", F.bitwise_not("key"))
    keys = tied.agg(F.count("*").alias("n"), F.min("turned").alias("low"), F.max("turned").alias("high")).first()
    drawn = (F.col("n_words") >= s.least_words) & (F.col("score") >= cut)
    if keys["n"] >= wanted - above:  # null keys among the ties come last and are not reached
        last, _ = bisect(tied, "turned", wanted - above, keys["low"], keys["high"])
        drawn = drawn & ((F.col("score") > cut) | F.coalesce(F.col("key") <= ~last, F.lit(False)))
    order = [F.desc("score"), F.asc_nulls_last("key"), F.asc("at")]
    chosen = ranked(scored.where(drawn), order, wanted, wanted)
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return chosen.select(*columns, "rank").union(rest.select(*columns, "rank")).withColumnRenamed("key", key)
