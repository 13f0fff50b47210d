"""Where a step takes its statistics from: the rows of a table, or what is known of them already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from millrace.plans.counts import modes, value_counts
from millrace.plans.quantiles import quantiles
from millrace.plans.statistics import statistics


class RowSource:
    """Statistics taken from rows. A summary of earlier tables offers the same four calls without rows."""

    def __init__(self, df: DataFrame):
        self.df = df

    def statistics(self, values: dict[str, Column], names, finite_only: bool = True) -> dict[str, dict]:
        return statistics(self.df, values, names)

    def quantiles(self, wanted: dict, bounds: dict | None = None) -> dict[str, list]:
        return quantiles(self.df, wanted, bounds)

    def modes(self, columns: list[str], as_type: str = "string") -> dict:
        return modes(self.df, columns, as_type)

    def counts(self, columns: list[str]) -> DataFrame:
        return value_counts(self.df, columns)
