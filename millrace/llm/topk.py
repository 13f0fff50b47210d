"""Exact top-k by inner product: everything is scored, global score histograms locate each kth score.

Queries are taken in blocks of bounded size; a block is sent to all tasks and scored against every vector,
in array products. Each round splits the score interval of every query into bins; a task reports, from the
top, only bins up to its own kth score, because no lower bin can hold the global one. The bin that holds the
kth score becomes the next interval, until few scores are at or above its lower end or it is one score wide.
A last pass keeps the scores from there on, each task at most k of them (ties to the smaller id), and ranks
them.

Components are turned into whole numbers, ``floor(scale * x)``, and scores are exact. Defined results: vectors
that are null or hold a null or a value that is not finite take no part, nor do rows without id. Only vectors
of the query's length are its candidates; none of its own id is. Repeated candidate rows each take a place;
query rows of equal id are one query, with the smallest vector. Scores beyond 64 bits are cut to the largest
or smallest number. Fewer than k candidates: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.frames import col, ready_workers

#: Queries of one block, on average; vectors scored at once; bins of a round.
QUERY_ROWS, VECTOR_ROWS, BINS = 1_024, 2_048, 512
#: An interval is narrow enough if at most so many times k scores are at or above its lower end.
ENOUGH = 8
#: Largest sum of products that doubles hold exactly, and largest score.
EXACT, LARGEST = float(1 << 53), (1 << 63) - 1

COUNTS = T.StructType([
    T.StructField("query", T.IntegerType()), T.StructField("bin", T.LongType()), T.StructField("n", T.LongType())])
FOUND = T.StructType([
    T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.LongType())])


@dataclass
class Block:
    """Queries of one length, and the interval (lower end, width of a bin) of each."""

    ids: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    width: np.ndarray
    need: np.ndarray
    open: np.ndarray
    k: int


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    big = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(
        vector, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < big), F.lit(False)))


def whole(values: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * values.astype(np.float64))


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """All inner products as 64-bit numbers."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    if np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1] < EXACT:
        return (queries @ vectors.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    found = exact(queries).dot(exact(vectors).T)
    return np.vectorize(lambda x: max(-LARGEST - 1, min(LARGEST, x)), otypes=[np.int64])(found)


def vectors_of(batch: pa.RecordBatch, length: int, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and whole vectors of this length, a bounded number at a time."""
    column = batch.column("vector")
    fits = pc.equal(pc.list_value_length(column), length)
    ids, column = batch.column("vec_id").filter(fits).to_numpy(zero_copy_only=False), column.filter(fits)
    for at in range(0, len(ids), VECTOR_ROWS):
        part = column.slice(at, VECTOR_ROWS)
        values = part.flatten().to_numpy(zero_copy_only=False)
        yield ids[at : at + VECTOR_ROWS], whole(values, scale).reshape(len(part), length)


def scored(block: Block, batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Vector ids, scores by query, and what is a candidate."""
    length = block.vectors.shape[1]
    for batch in batches:
        for ids, vectors in vectors_of(batch, length, scale):
            yield ids, products(block.vectors, vectors), block.ids[:, None] != ids[None, :]


def histogram(vectors: DataFrame, block: Block, scale: float) -> DataFrame:
    """``query``, ``bin`` and ``n`` for the upper bins of the queries that are still open."""
    shared, arrow = vectors.sparkSession.sparkContext.broadcast(block), to_arrow_schema(COUNTS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        counts = np.zeros((len(own.ids), BINS), np.int64)
        rows = np.arange(len(own.ids))[:, None] * BINS
        for _, scores, candidate in scored(own, batches, scale):
            at = np.floor_divide(scores - own.low[:, None], own.width[:, None])
            inside = candidate & (at >= 0) & (at < BINS) & own.open[:, None]
            counts += np.bincount((rows + at)[inside], minlength=counts.size).reshape(counts.shape)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        query, place = np.nonzero((counts > 0) & (above < own.need[:, None]))
        if len(query):
            yield pa.RecordBatch.from_arrays(
                [pa.array(query.astype(np.int32)), pa.array(place), pa.array(counts[query, place])], schema=arrow)

    return vectors.mapInArrow(work, COUNTS)


def refine(vectors: DataFrame, block: Block, scale: float) -> None:
    """One round: narrow the interval of every open query to the bin that holds its kth score."""
    down = Window.partitionBy("query").orderBy(F.desc("bin"))
    found = (
        histogram(vectors, block, scale).groupBy("query", "bin").agg(F.sum("n").alias("n"))
        .withColumn("reached", F.sum("n").over(down))
        .join(F.broadcast(vectors.sparkSession.createDataFrame(
            [(i, int(n)) for i, n in enumerate(block.need)], "query int, need long")), "query")
        .where("reached >= need and reached - n < need").select("query", "bin", "n", "reached").collect()
    )
    reached = np.zeros(len(block.ids), bool)
    for row in found:
        i = row["query"]
        reached[i] = True
        block.low[i] += row["bin"] * block.width[i]
        at_least = row["reached"] + block.k - block.need[i]
        block.need[i] -= row["reached"] - row["n"]
        block.open[i] = block.width[i] > 1 and at_least > ENOUGH * block.k
        block.width[i] = -(-block.width[i] // BINS)
    block.open &= reached  # fewer candidates than k: all of them are taken


def best(own: Block, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k highest scores of each query, ties to the smaller id."""
    order = np.lexsort((ids, -scores.astype(np.float64), query)) if np.abs(scores).max(initial=0) < EXACT else np.array(
        sorted(range(len(ids)), key=lambda i: (query[i], -int(scores[i]), ids[i])), np.int64)
    query, ids, scores = query[order], ids[order], scores[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    kept = rank < own.k
    return query[kept], ids[kept], scores[kept]


def final(vectors: DataFrame, block: Block, scale: float) -> DataFrame:
    """``query_id``, ``vec_id``, ``score`` from the located scores on, at most k of each task and query."""
    shared, arrow = vectors.sparkSession.sparkContext.broadcast(block), to_arrow_schema(FOUND)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        kept = (np.zeros(0, np.int64),) * 3
        for ids, scores, candidate in scored(own, batches, scale):
            query, at = np.nonzero(candidate & (scores >= own.low[:, None]))
            new = (query, ids[at], scores[query, at])
            kept = best(own, *(np.concatenate(p) for p in zip(kept, new, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(own.ids[kept[0]]), pa.array(kept[1]), pa.array(kept[2])], schema=arrow)

    return vectors.mapInArrow(work, FOUND)


def top_k(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k best vectors of each query row."""
    spark = df.sparkSession
    ready_workers(spark)
    marked = df.select(col(key).cast("long").alias("vec_id"), col(vector).cast("array<double>").alias("vector"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"))
    taking = marked.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    vectors = taking.select("vec_id", "vector")
    queries = taking.where("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = -(-queries.count() // query_rows)
    reach = vectors.agg(F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))).first()[0] or 0.0
    results = []
    for number in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number).collect()
        by_length: dict[int, list] = {}
        for row in rows:
            by_length.setdefault(len(row["vector"]), []).append(row)
        for length, group in sorted(by_length.items()):
            own = np.array([r["vector"] for r in group], np.float64).reshape(len(group), length)
            ids, own = np.array([r["vec_id"] for r in group], np.int64), whole(own, scale)
            most = np.minimum(np.abs(own).sum(1) * (scale * reach + 1) + 1, float(1 << 61)).astype(np.int64)
            block = Block(ids, own, -most, -(-(2 * most + 1) // BINS), np.full(len(ids), k), np.full(len(ids), True), k)
            while block.open.any():
                refine(vectors, block, scale)
            results.append(final(vectors, block, scale))
    if not results:
        results = [spark.createDataFrame([], FOUND)]
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        reduce(DataFrame.union, results).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
