"""Sessions: runs of one entity's rows without a longer pause, and what each of them amounts to.

Rows are put in ranges of ``(entity, time, row_id)``, so that an entity that holds a third of all rows is cut
by time first. Whether a row starts a session, and how many sessions its entity has had, needs one value per
range from the ranges before it. The aggregate of a session is combined before the shuffle, so a
session that never ends is no hot group either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, epoch_micros, without_nan
from millrace.operators.sampling import AGGREGATIONS
from millrace.plans.order import BUCKET, entity_ranges, from_earlier_ranges, last_before, running_totals
from millrace.session import materialize


def with_sessions(
    df: DataFrame, entity: str, time: str, row_id: str, gap_seconds: float, name: str = "session", parts: int | None = None
) -> DataFrame:
    """Add the number of every row's session within its entity, from 0.

    A row starts a session if its entity has no row in the ``gap_seconds`` up to it. Rows without time are in no
    session; rows without an entity belong to one entity.
    """
    if gap_seconds <= 0:
        raise ValueError("the gap must be positive")
    micros, gap = epoch_micros(df, time), int(gap_seconds * 1_000_000)
    placed = df.withColumn("__at", micros)
    order = [F.col("__at"), col(row_id)]
    dealt = entity_ranges(placed, entity, order, parts)
    in_order = Window.partitionBy(BUCKET, col(entity)).orderBy(*order)
    before = last_before(dealt, entity, F.struct(*order), F.col("__at"), T.LongType())
    previous = F.coalesce(F.lag("__at").over(in_order), from_earlier_ranges(entity))
    starts = F.col("__at").isNotNull() & (previous.isNull() | (F.col("__at") - previous > gap))
    flagged = dealt.join(before, BUCKET).withColumn("__starts", starts.cast("int")).drop("__first", "__start")
    flagged = materialize(flagged)
    total = running_totals(flagged, entity, F.col("__starts"))
    number = F.coalesce(from_earlier_ranges(entity), F.lit(0)) + F.sum("__starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - 1
    numbered = flagged.join(total, BUCKET).withColumn(name, F.when(F.col("__at").isNotNull(), number).cast("long"))
    return numbered.select(*(col(c) for c in df.columns if c != name), col(name))


def sessionize(
    df: DataFrame, entity: str, time: str, row_id: str, gap_seconds: float, aggregation: dict[str, str] | None = None,
    extra: dict[str, Column] | None = None, parts: int | None = None,
) -> DataFrame:
    """One row per session: entity, ``session``, ``start``, ``end``, ``n``, ``seconds``, and the aggregates.

    ``aggregation`` names one of the resampler's aggregates per column, ``extra`` any other aggregate by name.
    """
    unknown = sorted(set((aggregation or {}).values()) - set(AGGREGATIONS))
    if unknown:
        raise ValueError(f"unknown aggregation {unknown}; use one of {list(AGGREGATIONS)}")
    rows = with_sessions(df, entity, time, row_id, gap_seconds, "session", parts).where("session is not null")
    micros = epoch_micros(df, time)
    made = {c: AGGREGATIONS[a](without_nan(df, c)) for c, a in (aggregation or {}).items()} | (extra or {})
    return rows.groupBy(col(entity), "session").agg(
        F.min(col(time)).alias("start"), F.max(col(time)).alias("end"), F.count(F.lit(1)).alias("n"),
        ((F.max(micros) - F.min(micros)) / 1_000_000).alias("seconds"), *(a.alias(n) for n, a in made.items()))
