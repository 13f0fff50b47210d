"""Load, check and write tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

READERS = {"csv": {"header": "true"}, "parquet": {}, "json": {}, "orc": {}}


def _read(spark: SparkSession, paths: list[str], fmt: str, schema, **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**READERS[fmt], **options)
    return (reader.schema(schema) if schema else reader).load(paths)


def load_tables(
    spark: SparkSession,
    input_files: list[str] = (),
    pattern: str | None = None,
    data_dir: str | None = None,
    fmt: str | None = None,
    schema=None,
) -> DataFrame:
    """The listed files and every file of ``data_dir`` whose name fits ``pattern``, as one table.

    Files of one format are read by one scan; different formats are matched by column name.
    """
    if not input_files and not pattern:
        raise ValueError("name input_files, a pattern, or both")
    base = f"{data_dir.rstrip('/')}/" if data_dir else ""
    by_format: dict[str, list[str]] = {}
    for name in input_files:
        kind = fmt or name.rsplit(".", 1)[-1].lower()
        by_format.setdefault(kind, []).append(name if "/" in name else base + name)
    parts = [_read(spark, paths, kind, schema) for kind, paths in by_format.items()]
    if pattern:
        if not data_dir:
            raise ValueError("a pattern needs data_dir")
        kind = fmt or pattern.rsplit(".", 1)[-1].lower()
        parts.append(_read(spark, [data_dir], kind, schema, pathGlobFilter=pattern))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def require_valid(df: DataFrame, columns: list[str] = (), label: str | None = None) -> DataFrame:
    """Reject anything that is not a table with columns and at least one row."""
    if df is None:
        raise ValueError("the input table is missing")
    if not hasattr(df, "schema"):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    if not df.columns:
        raise ValueError("the input table has no columns")
    absent = [c for c in [*columns, *([label] if label else [])] if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in the table: {absent}")
    if df.isEmpty():
        raise ValueError("the input table has no rows")
    return df


@dataclass(frozen=True)
class SideOutput:
    """Optional export of the rows a step removed or marked."""

    enabled: bool = False
    path: str = ""
    filename: str = ""

    def write(self, df: DataFrame) -> DataFrame:
        """Write ``df`` in the format of the file name and read it back; unchanged when disabled."""
        if not self.enabled:
            return df
        if not self.path or not self.filename:
            raise ValueError("an enabled side output needs path and filename")
        target = f"{self.path.rstrip('/')}/{self.filename}"
        kind = self.filename.rsplit(".", 1)[-1].lower()
        df.write.mode("overwrite").format(kind).options(**READERS[kind]).save(target)
        return _read(df.sparkSession, [target], kind, df.schema)


def to_result_frame(df: DataFrame, time: str, forecasts: list[str], view: str | None = None) -> DataFrame:
    """Forecast columns beside their time stamps, optionally registered as a view."""
    result = df.select(time, *forecasts)
    if view:
        result.createOrReplaceTempView(view)
    return result
