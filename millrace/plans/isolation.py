"""Isolation forest on one column.

An isolation forest is defined on small subsamples (256 values per tree), so the trees grow on the
driver. Their values are chosen from all rows by a hash of the row key: the rows with the smallest
hashes, dealt out to the trees in that order, so that no tree shares a row with another. Where the
table has fewer rows than that, every tree draws from all of them. Over one column the mean path length is a step function
of the value: scoring all rows is a lookup of the value's step, one aggregate counts the rows per
step, and the steps above the cut-off merge into a short list of value ranges. Rows are flagged by
comparing with those ranges, which is a plain column expression.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col

TREE_ROWS = 256
TREES = 100
EULER_GAMMA = 0.5772156649015329
LARGEST_HASH = 2**63


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search among n values."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


def _grow(values: np.ndarray, rng: np.random.Generator) -> list[tuple[float, float]]:
    """One tree as steps ``[(left edge, path length), …]`` in ascending order."""
    limit = math.ceil(math.log2(max(2, len(values))))
    steps: list[tuple[float, float]] = []
    pending = [(float("-inf"), np.sort(values), 0)]
    while pending:
        edge, part, depth = pending.pop()
        if depth == limit or len(part) <= 1 or part[0] == part[-1]:
            steps.append((edge, depth + average_path(len(part))))
            continue
        cut = rng.uniform(part[0], part[-1])
        place = int(np.searchsorted(part, cut, side="left"))
        pending.append((cut, part[place:], depth + 1))
        pending.append((edge, part[:place], depth + 1))
    return steps


def anomaly_steps(
    pool: np.ndarray, seed: int, count: int = TREES, tree_rows: int = TREE_ROWS
) -> tuple[np.ndarray, np.ndarray]:
    """Left edges and anomaly scores (0…1, high is anomalous) of the forest's step function."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(pool))
    if len(pool) >= count * tree_rows:
        parts = [pool[i * tree_rows : (i + 1) * tree_rows] for i in range(count)]
    else:
        ordered = np.sort(pool)
        parts = [rng.choice(ordered, size, replace=False) for _ in range(count)]
    trees = [_grow(part, rng) for part in parts]
    edges = np.unique(np.array([e for tree in trees for e, _ in tree]))
    total = np.zeros(len(edges))
    for tree in trees:
        starts = np.array([e for e, _ in tree])
        lengths = np.array([d for _, d in tree])
        total += lengths[np.searchsorted(starts, edges, side="right") - 1]
    return edges, 2.0 ** (-(total / len(trees)) / average_path(size))


def draw_pool(
    df: DataFrame, value: Column, rows: int, seed: int, row_id: Column | None, wanted: int
) -> np.ndarray:
    """The values of the ``wanted`` rows with the smallest hashes, in the order of the hashes.

    The hash is taken over the row id, or over the whole row where there is none.
    """
    keys = [row_id] if row_id is not None else [col(c) for c in df.columns]
    place = F.xxhash64(*keys, F.lit(seed)).bitwiseAND(F.lit(LARGEST_HASH - 1))
    keyed = df.select(value.alias("x"), place.alias("place")).where(F.col("x").isNotNull())
    share = 2.0 * wanted / max(1, rows)
    if share < 1.0:  # twice the rows that are wanted are left to sort
        keyed = keyed.where(F.col("place") < F.lit(int(share * LARGEST_HASH)))
    picked = keyed.orderBy("place", "x").limit(wanted).collect()
    return np.array([r["x"] for r in picked], dtype=float)


def anomalous_ranges(
    df: DataFrame,
    value: Column,
    rows: int,
    contamination: float,
    seed: int,
    row_id: Column | None = None,
    trees: int = TREES,
    tree_rows: int = TREE_ROWS,
) -> list[list[float | None]]:
    """Value ranges ``[from, to)`` whose score lies above the ``1 - contamination`` quantile of all
    rows; ``None`` marks an open end."""
    pool = draw_pool(df, value, rows, seed, row_id, trees * tree_rows)
    if len(pool) < 2 or pool.min() == pool.max():
        return []
    edges, scores = anomaly_steps(pool, seed, trees, tree_rows)
    keyed = df.select(value.alias("x")).where(F.col("x").isNotNull())
    steps = Bucketizer(splits=[*edges.tolist(), float("inf")], inputCol="x", outputCol="step")
    counted = steps.transform(keyed).groupBy("step").count().collect()
    counts = np.zeros(len(edges))
    for row in counted:
        counts[int(row["step"])] = row["count"]

    order = np.argsort(scores, kind="stable")
    reached = np.cumsum(counts[order])
    place = int(np.searchsorted(reached, (1.0 - contamination) * reached[-1], side="left"))
    limit = scores[order][min(place, len(order) - 1)]
    flagged = scores > limit
    ranges: list[list[float | None]] = []
    for i, bad in enumerate(flagged):
        if not bad:
            continue
        end = float(edges[i + 1]) if i + 1 < len(edges) else None
        if ranges and i and flagged[i - 1]:
            ranges[-1][1] = end
        else:
            ranges.append([float(edges[i]) if i else None, end])
    return ranges


def in_ranges(value: Column, ranges: list[list[float | None]]) -> Column:
    hit = F.lit(False)
    for low, high in ranges:
        above = F.lit(True) if low is None else value >= F.lit(low)
        under = F.lit(True) if high is None else value < F.lit(high)
        hit = hit | (above & under)
    return hit
