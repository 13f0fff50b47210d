"""Exact order statistics that never gather a column in one task.

Spark's exact ``percentile`` keeps one map of all distinct values in the final task. That is the
right plan for few values and impossible for many. Above ``SMALL`` values per column, or ten times
as many over all columns, the value at a rank is found by narrowing instead: the interval known to
hold it is cut into ``CELLS`` equal cells, one aggregate counts each cell together with its smallest
and largest value, and the cell holding the rank becomes the next interval. Each round returns at
most ``CELLS`` rows per interval and ends as soon as the cell holds a single distinct value or the
rank falls on its edge. A value repeated in a third of all rows is no special case. Every round
separates the smallest from the largest value, so the search always ends.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL = 200_000
CELLS = 1024
LARGEST = sys.float_info.max


@dataclass
class _Target:
    key: str
    rank: int
    low: float
    high: float
    log: bool = False
    below: int = 0
    value: float | None = None
    count: int = 0

    @property
    def interval(self) -> tuple:
        return self.key, self.low, self.high, self.log


def _cell(intervals: list[tuple]) -> Column:
    """Cell number of ``x`` inside interval ``i``; never decreasing in ``x``."""

    def bound(place: int, within=lambda value: value) -> Column:
        return F.get(F.array(*(F.lit(within(interval[place])) for interval in intervals)), F.col("i"))

    x, low, high, log = F.col("x"), bound(1), bound(2), bound(3)
    lowest, highest = low, high
    if all(isinstance(interval[1], int) for interval in intervals):
        share = (x - low).cast("double") / (high - low).cast("double")
    else:
        # Steps run between finite ends; the infinities have the outermost cells to themselves.
        low, high = bound(1, _finite), bound(2, _finite)
        share = (x * 0.5 - low * 0.5) / (high * 0.5 - low * 0.5)
    if any(interval[3] for interval in intervals):
        share = F.when(log & (low > 0), F.ln(x / low) / F.ln(high / low)).otherwise(share)
    inner = F.greatest(F.lit(0), F.least(F.lit(CELLS - 1), F.floor(share * CELLS)))
    inner = F.when(lowest < low, F.greatest(F.lit(1), inner)).otherwise(inner)
    inner = F.when(highest > high, F.least(F.lit(CELLS - 2), inner)).otherwise(inner)
    return F.when(x <= lowest, 0).when(x >= highest, CELLS - 1).otherwise(inner).cast("int")


def _finite(value):
    """The value, infinities as the outermost finite numbers."""
    return max(-LARGEST, min(LARGEST, value)) if isinstance(value, float) else value


def _histograms(df: DataFrame, values: dict[str, Column], intervals: list[tuple]) -> dict:
    """``{interval: [(count, min, max), …] in order}`` from one pass over the rows in the intervals.

    Intervals of one expression never overlap, so a row counts at most once per expression. Rows
    outside all intervals share the group NULL, which each task folds into one row; there is no
    filter, so that an expensive expression is computed once per row.
    """
    keys = list(dict.fromkeys(interval[0] for interval in intervals))
    df = df.select(*(values[key].alias(f"v{k}") for k, key in enumerate(keys)))
    which: dict[str, Column] = {}
    for i, (key, low, high, _) in enumerate(intervals):
        inside = F.col(f"v{keys.index(key)}").between(F.lit(low), F.lit(high))
        which[key] = which[key].when(inside, i) if key in which else F.when(inside, i)
    parts = [(which[key].alias("i"), F.col(f"v{k}").alias("x")) for k, key in enumerate(keys)]
    if len(parts) == 1:
        long = df.select(*parts[0])
    else:
        long = df.select(F.inline(F.array(*(F.struct(*part) for part in parts))))
    rows = (
        long.select("i", _cell(intervals).alias("cell"), "x")
        .groupBy("i", "cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        .collect()
    )
    found: dict = {interval: [] for interval in intervals}
    for row in sorted((r for r in rows if r["i"] is not None), key=lambda r: (r["i"], r["cell"])):
        found[intervals[row["i"]]].append((row["n"], row["low"], row["high"]))
    return found


def _narrow(target: _Target, cells: list[tuple]) -> None:
    below = target.below
    for n, low, high in cells:
        if target.rank < below + n:
            break
        below += n
    # Where equal steps leave most rows in one cell, the next cells are equal ratios.
    target.log = not target.log and 2 * n > sum(count for count, _, _ in cells)
    target.below = below
    first, last = target.rank == below, target.rank == below + n - 1
    if low == high:
        target.value, target.count = low, n
    elif first:
        target.value = low
    elif last:
        target.value = high
    target.low, target.high = low, high


def values_at_ranks(
    df: DataFrame,
    values: dict[str, Column],
    ranks: dict[str, list[int]],
    bounds: dict[str, tuple],
    resolve_ties: bool = False,
) -> dict[str, list[_Target]]:
    """The value at each 0-based rank of each ascending expression; NULLs take no rank.

    With ``resolve_ties`` the search goes on until the number of rows equal to the value and the
    number of rows below it are known as well.
    """
    targets = [_Target(key, rank, *bounds[key]) for key in ranks for rank in ranks[key]]
    open_targets = targets
    while open_targets:
        intervals = sorted({t.interval for t in open_targets})
        cells = _histograms(df, values, intervals)
        for target in open_targets:
            _narrow(target, cells[target.interval])
        open_targets = [
            t for t in open_targets if t.value is None or (resolve_ties and t.count == 0)
        ]
        for target in open_targets:
            target.value = None
    return {key: [t for t in targets if t.key == key] for key in ranks}


def quantiles(
    df: DataFrame,
    wanted: dict[str, tuple[Column, list[float]]],
    bounds: dict[str, dict] | None = None,
    small: int = SMALL,
) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of many expressions.

    ``bounds`` are known ``n``/``min``/``max`` of each expression; they cost one aggregate otherwise.
    """
    if not wanted:
        return {}
    values = {key: column for key, (column, _) in wanted.items()}
    if bounds is None:
        from millrace.plans.statistics import statistics

        bounds = statistics(df, values, ["n", "min", "max"])
    sizes = [bounds[key]["n"] for key in wanted]
    if max(sizes) <= small and sum(sizes) <= 10 * small:
        keys = list(wanted)
        row = df.agg(
            *(
                F.percentile(wanted[k][0], F.array(*map(F.lit, wanted[k][1]))).alias(f"q{i}")
                for i, k in enumerate(keys)
            )
        ).first()
        return {
            k: list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(wanted[k][1])
            for i, k in enumerate(keys)
        }

    ranks: dict[str, list[int]] = {}
    for key, (_, shares) in wanted.items():
        n = bounds[key]["n"]
        if n:
            spots = [share * (n - 1) for share in shares]
            ranks[key] = sorted({f(s) for s in spots for f in (math.floor, math.ceil)})
    found = values_at_ranks(
        df, values, ranks, {k: (bounds[k]["min"], bounds[k]["max"]) for k in ranks}
    )
    result: dict[str, list[float | None]] = {}
    for key, (_, shares) in wanted.items():
        if key not in found:
            result[key] = [None] * len(shares)
            continue
        at = {t.rank: t.value for t in found[key]}
        result[key] = []
        for share in shares:
            spot = share * (bounds[key]["n"] - 1)
            low, high, part = at[math.floor(spot)], at[math.ceil(spot)], spot - math.floor(spot)
            # The weighted sum of ``percentile``, so that both ways agree, infinities included.
            result[key].append(low if part == 0 or low == high else low * (1 - part) + high * part)
    return result
