"""Train / validation / test labels with exact sizes, in time order or shuffled by a seed."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, epoch_micros
from millrace.plans.order import EARLIEST, before, keys_at_ranks

NAMES = ("train", "val", "test")


@dataclass(frozen=True)
class Ratios:
    train: float = 0.6
    val: float = 0.3
    test: float = 0.1

    def __post_init__(self):
        shares = (self.train, self.val, self.test)
        if any(not isinstance(s, (int, float)) or s < 0 or s > 1 for s in shares):
            raise ValueError("every ratio must lie between 0 and 1")
        if not math.isclose(sum(shares), 1.0, abs_tol=1e-9):
            raise ValueError("the ratios must sum to 1")

    def sizes(self, n: int) -> tuple[int, int, int]:
        """Rows per part: shares rounded half up, the rest to the last part."""
        train = min(n, math.floor(n * self.train + 0.5))
        val = min(n - train, math.floor(n * self.val + 0.5))
        return train, val, n - train - val


def _label(df: DataFrame, ratios: Ratios, first: Column, second: Column) -> DataFrame:
    """Label rows by two cut keys. Counting finds them, so the rows themselves are never shuffled
    and a filter on the label becomes a filter on the order columns."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("low"), F.max(first).alias("high")).first()
    train, val, test = ratios.sizes(row["n"])
    ranks = [r for r in {train, train + val} if r < row["n"]]
    keys = keys_at_ranks(df, first, second, ranks, (row["low"], row["high"])) if ranks else {}
    always = F.lit(True)
    in_train = before(first, second, keys[train]) if train in keys else always
    in_val = before(first, second, keys[train + val]) if train + val in keys else always
    label = F.when(in_train, NAMES[0]).when(in_val, NAMES[1]).otherwise(NAMES[2])
    return df.withColumn("split", label)


@dataclass(frozen=True)
class TimeSplit:
    """``split`` = train, val, test along ``(time, row_id)``; never shuffles."""

    ratios: Ratios = Ratios()

    def with_params(self, **changes) -> "TimeSplit":
        return replace(self, ratios=replace(self.ratios, **changes))

    def apply(self, df: DataFrame, time: str, row_id: str) -> DataFrame:
        first = F.coalesce(epoch_micros(df, time), F.lit(EARLIEST))
        return _label(df, self.ratios, first, col(row_id).cast("long"))


@dataclass(frozen=True)
class ShuffledSplit:
    """``split`` by a reproducible order: the MD5 of row id and seed (its first 60 bits), then the id.

    The same seed gives the same split on any cluster size, and the sizes are exact.
    """

    ratios: Ratios = Ratios()
    seed: int = 42
    shuffle: bool = True

    def with_params(self, **changes) -> "ShuffledSplit":
        own = {k: v for k, v in changes.items() if k in ("seed", "shuffle")}
        shares = {k: v for k, v in changes.items() if k not in own}
        return replace(self, ratios=replace(self.ratios, **shares), **own)

    def apply(self, df: DataFrame, row_id: str) -> DataFrame:
        if not df.limit(2).count() > 1:
            raise ValueError("a table of fewer than two rows cannot be split")
        second = col(row_id).cast("long")
        if not self.shuffle:
            return _label(df, self.ratios, second, F.lit(0).cast("long"))
        digest = F.md5(F.concat_ws(":", second.cast("string"), F.lit(str(self.seed))))
        first = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
        return _label(df, self.ratios, first, second)
