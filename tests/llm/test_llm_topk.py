"""Exact top-k against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score int, vector string"


def brute(rows, k, scale=256):
    whole = [
        (i, [math.floor(scale * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = {}
    for i, v in sorted((w for w in whole if w[0] % 50 == 0), key=lambda w: (w[0], w[1])):
        queries.setdefault(i, v)
    found = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, c, strict=True)), i) for i, c in whole if i != q and len(c) == len(v))
        found += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(found)


def rows_of(kind):
    random.seed(kind)
    if kind == "mixed":
        rows = [(i, [random.gauss(0, 1) for _ in range(12)]) for i in range(700)]
        rows += [(800, None), (850, [float("nan")] * 12), (900, [None] * 12), (901, [float("inf")] * 12), (None, [1.0] * 12)]
        rows += [(950, [1.0, 2.0]), (951, [3.0, -4.0]), (1000, []), (1001, []), (1050, [5.0] * 3), rows[3], rows[50]]
    elif kind == "ties":
        rows = [(i, [1.0, 0.0]) for i in range(1, 400)] + [(500 + i, [0.5, i % 3]) for i in range(101)]
    elif kind == "large":
        rows = [(i, [random.choice([1e4, -1e5, 1e6, 0.001]) for _ in range(5)]) for i in range(200)]
    else:
        rows = [(50, [1.0]), (100, [2.0]), (3, [-1.0])]
    import struct

    single = lambda x: x if x is None else struct.unpack("f", struct.pack("f", x))[0]
    return [(i, v if v is None else [single(x) for x in v]) for i, v in rows]


@pytest.mark.parametrize("kind", ["mixed", "ties", "large", "few"])
@pytest.mark.parametrize("bins, query_rows", [(512, 1024), (32, 7)])
def test_matches_brute_force(spark, monkeypatch, kind, bins, query_rows):
    if bins == 32:
        monkeypatch.setattr(topk, "BINS", bins)
        monkeypatch.setattr(topk, "ENOUGH", 1)
    rows = rows_of(kind)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    found = topk.top_k(df, F.col("vec_id") % 50 == 0, k=5, query_rows=query_rows)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, 5)


def test_empty_table_and_no_queries(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(1, [1.0], 1, "x")], SCHEMA)
    assert topk.top_k(one, F.col("vec_id") % 50 == 0).collect() == []


def test_scores_beyond_64_bits_are_cut():
    import numpy as np

    found = topk.products(np.array([[2.0**40, 1.0]]), np.array([[2.0**40, 0.0], [-(2.0**40), 0.0], [1.0, 2.0]]))
    assert found.tolist() == [[topk.LARGEST, -topk.LARGEST - 1, 2**40 + 2]]
