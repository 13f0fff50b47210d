"""Streams: fitted steps are projections and need no state; resampling needs a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, without_nan
from millrace.operators.base import Fitted
from millrace.operators.sampling import AGGREGATIONS, frequency_seconds


def apply_fitted(stream: DataFrame, models: list[Fitted]) -> DataFrame:
    """Apply steps learned on a batch table to a stream, row by row."""
    for model in models:
        stream = model.transform(stream)
    return stream


def resample_stream(
    stream: DataFrame, time: str, freq: str, aggregation: dict[str, str], late: str
) -> DataFrame:
    """Time buckets as in the batch resampler; a bucket closes once the watermark passes its end.

    ``time`` must be a TIMESTAMP; rows later than ``late`` are dropped by Spark.
    """
    seconds = frequency_seconds(freq)
    if 86_400 % seconds:
        raise ValueError("on a stream the frequency must divide a day")
    return (
        stream.withWatermark(time, late)
        .groupBy(F.window(col(time), f"{seconds} seconds").alias("__window"))
        .agg(*(AGGREGATIONS[a](without_nan(stream, c)).alias(c) for c, a in aggregation.items()))
        .select(F.col("__window.start").alias(time), *(col(c) for c in aggregation))
    )
