"""Counts per distinct value for several columns at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, number


def value_counts(df: DataFrame, columns: list[str], as_type: str = "string") -> DataFrame:
    """Long table ``(column, value, n)`` without NULLs, for all columns in one shuffle.

    All values are read as one type; as DOUBLE, NaN is read as missing.

    Rows are combined before the shuffle, so a value held by a third of the table sends one row
    per task.
    """
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (number(df, c) if as_type == "double" else col(c).cast(as_type)).alias("value"),
        )
        for c in columns
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, columns: list[str], as_type: str = "string") -> dict:
    """Most frequent value per column; the smallest value wins a tie."""
    if not columns:
        return {}
    best = (
        value_counts(df, columns, as_type)
        .groupBy("column")
        .agg(F.min(F.struct((-F.col("n")).alias("order"), F.col("value"))).alias("best"))
        .collect()
    )
    found = {row["column"]: row["best"]["value"] for row in best}
    return {c: found.get(c) for c in columns}
