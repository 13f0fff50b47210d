"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one pass of array code works on; bounds the memory of a task.
CHUNK_BYTES = 1 << 19
#: Rows that a Python worker gets at once, at most.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000


def ready_workers(spark: SparkSession) -> None:
    """Let the Python workers of a local session find this package where the driver found it (on a cluster
    the package is shipped with ``--py-files``), and keep the batches they get small: rows hold whole texts.
    """
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if spark.sparkContext.master.startswith("local") and root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(p for p in (root, env.get("PYTHONPATH", "")) if p)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def col(name: str) -> Column:
    """The column of exactly this name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_fields(df: DataFrame, *fields: T.StructField) -> T.StructType:
    """The schema of the table with these columns at the end; columns of the same names are replaced."""
    new = {f.name.lower() for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in new] + list(fields))


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batch with at most ``limit`` bytes of text each, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a column, nulls as empty texts."""
    return [t or "" for t in batch.column(column).to_pylist()]


def extended(batch: pa.RecordBatch, schema: pa.Schema, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch in this schema, with new columns added or replaced."""
    arrays = []
    for field in schema:
        array = new[field.name] if field.name in new else batch.column(field.name)
        arrays.append(array if array.type == field.type else array.cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """One list per length, cut from the values in order."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start, start + 1, …`` of all ranges, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - before, lengths)


#: Rows of a key table that may be broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000


def without(df: DataFrame, keys: DataFrame, on: dict[str, str]) -> DataFrame:
    """The rows whose columns equal no row of ``keys`` (nulls equal nulls); ``on`` maps column to key column.

    The key table is counted: a small one is broadcast, so that wide rows stay where they are.
    """
    small = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    names = {k: f"key_{i}" for i, k in enumerate(on.values())}
    keys = keys.select(*(col(k).alias(n) for k, n in names.items()))
    held = df.select(F.struct(*map(col, df.columns)).alias("row"))
    matches = [F.col("row").getField(c).eqNullSafe(F.col(names[k])) for c, k in on.items()]
    found = held.join(F.broadcast(keys) if small else keys, matches, "left_anti")
    return found.select("row.*")
