"""Connected components of a link table, by rounds of large and small stars on DataFrames.

A large star links the larger neighbours of a node to the smallest neighbour; a small star links the
smaller ones and the node itself. Both keep components whole and end in one star around the smallest
node of each. Every step is a grouped minimum (combined before the shuffle) and an equi-join; links
are written to the shared folder each round, so lineage stays short and a lost executor re-reads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

ROUNDS = 60


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of all nodes that have links.

    ``links`` has two comparable columns ``a`` and ``b``; order and repeats don't matter, links of a
    node to itself and nulls are left out.
    """
    links = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    for _ in range(ROUNDS):
        links = materialize(_small(_large(links)).distinct())
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = seen
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
