"""Duplicate rows: keep the first, or list the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.sources.tables import SideOutput


def _keys(df: DataFrame, row_id: str, columns: list[str] | None, label: str | None) -> list[str]:
    keys = [c for c in df.columns if c != row_id] if columns is None else list(columns)
    return keys + [label] if label and label not in keys else keys


def dedup_rows(
    df: DataFrame, row_id: str, columns: list[str] | None = None, label: str | None = None
) -> DataFrame:
    """Keep the row with the smallest ``row_id`` of every group of equal rows.

    Rows are equal when all columns but ``row_id`` (or the given ones, plus the label) are equal;
    NULLs are equal to each other. Grouping is a hash aggregate that combines copies before the shuffle,
    so a group holding a third of the table sends one row per task. Columns outside the key come with
    their row by a semi join on the unique ``row_id``, so that no key is hot and nothing is sorted by text.
    """
    keys = _keys(df, row_id, columns, label)
    others = [c for c in df.columns if c not in keys and c != row_id]
    first = F.min(col(row_id)).alias(row_id)
    grouped = df.groupBy(*(col(k) for k in keys))
    if not others:
        return grouped.agg(first).select(*(col(c) for c in df.columns))
    kept = grouped.agg(first).select(col(row_id))
    return df.join(kept, row_id, "left_semi").select(*(col(c) for c in df.columns))


def duplicate_rows(
    df: DataFrame, row_id: str, columns: list[str] | None = None, label: str | None = None
) -> DataFrame:
    """The rows :func:`dedup_rows` removes: an anti join on the unique ``row_id``, so no key is hot."""
    keys = _keys(df, row_id, columns, label)
    kept = df.groupBy(*(col(k) for k in keys)).agg(F.min(col(row_id)).alias(row_id)).select(col(row_id))
    return df.join(kept, row_id, "left_anti").select(*(col(c) for c in df.columns))


@dataclass(frozen=True)
class RemoveDuplicates:
    """The row-changing step: keep first rows, and export the removed ones where asked."""

    row_id: str
    columns: tuple[str, ...] | None = None
    label: str | None = None
    removed: SideOutput = SideOutput()

    def apply(self, df: DataFrame) -> DataFrame:
        if self.removed.enabled:
            self.removed.write(duplicate_rows(df, self.row_id, self.columns, self.label))
        return dedup_rows(df, self.row_id, self.columns, self.label)
