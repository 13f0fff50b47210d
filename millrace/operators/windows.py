"""Sliding windows over one ordered series or one series per entity, and their label matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import col, number
from millrace.plans.order import with_entity_position, with_position

CHUNK_ROWS = 200_000


@dataclass(frozen=True)
class WindowSettings:
    """``input_width`` rows, and the last ``label_width`` of the rows up to ``shift`` after them.

    With 6 / 5 / 24 a window spans 30 rows; inputs are rows 0–5, labels rows 25–29.
    """

    label_columns: tuple[str, ...]
    feature_columns: tuple[str, ...]
    input_width: int = 6
    label_width: int = 5
    shift: int = 24

    def __post_init__(self):
        if min(self.input_width, self.label_width, self.shift) < 1:
            raise ValueError("widths and shift must be at least 1")
        if self.label_width > self.total:
            raise ValueError("the labels do not fit into the window")

    @property
    def total(self) -> int:
        return self.input_width + self.shift

    @property
    def label_start(self) -> int:
        return self.total - self.label_width


def make_windows(
    df: DataFrame,
    settings: WindowSettings,
    time: str,
    row_id: str,
    chunk_rows: int = CHUNK_ROWS,
    buckets: int | None = None,
    entity: str | None = None,
) -> DataFrame:
    """One row per window: ``start_pos``, its start time, ``in_<feature>`` and ``out_<label>`` arrays.

    With ``entity`` every entity is a series of its own: it leads the result, and ``start_pos`` counts from 0 in
    each of them. Chunks are then cut inside entities, so that one of them may hold most rows.

    Positions come from the global order. Rows are then grouped into chunks of consecutive positions;
    the first ``total - 1`` rows of a chunk are also given to the chunk before it, so that every
    window lies inside one chunk. The last ``total - 1`` rows start no window.
    """
    s = settings
    chunk_rows = max(chunk_rows, s.total)
    used = sorted({*s.feature_columns, *s.label_columns})
    keys = [] if entity is None else [col(entity)]
    narrow = df.select(col(time), col(row_id), *keys, *(number(df, c).alias(c) for c in used if c != entity))
    if entity is None:
        placed = with_position(narrow, time, row_id, "start_pos", buckets)
    else:
        placed = with_entity_position(narrow, entity, time, row_id, "start_pos", buckets)
    chunk = F.floor(F.col("start_pos") / F.lit(chunk_rows)).cast("long")
    shared = (F.col("start_pos") % chunk_rows < s.total - 1) & (chunk > 0)
    homes = F.when(shared, F.array(chunk, chunk - 1)).otherwise(F.array(chunk))
    spread = placed.withColumn("__home", chunk).withColumn("__chunk", F.explode(homes))
    in_chunk = Window.partitionBy(*keys, "__chunk").orderBy("start_pos")

    def gather(name: str, first: int, last: int) -> Column:
        # A struct keeps NULL elements, which collect_list alone would drop.
        cells = F.collect_list(F.struct(col(name).alias("v"))).over(in_chunk.rowsBetween(first, last))
        return F.transform(cells, lambda cell: cell["v"])

    arrays = {f"in_{c}": gather(c, 0, s.input_width - 1) for c in s.feature_columns}
    arrays |= {f"out_{c}": gather(c, s.label_start, s.total - 1) for c in s.label_columns}
    whole = F.size(col(f"out_{s.label_columns[0]}")) == s.label_width
    return (
        spread.withColumns(arrays)
        .where(whole & (F.col("__home") == F.col("__chunk")))
        .select(*keys, "start_pos", col(time).alias("start_time"), *(col(a) for a in arrays))
    )


def label_matrix(windows: DataFrame, settings: WindowSettings) -> DataFrame:
    """Long form of the labels: ``(start_pos, label, step, y_true)`` with steps from 1."""
    steps = F.sequence(F.lit(1), F.lit(settings.label_width))

    def cells(label: str) -> Column:
        def pair(step, value):
            return F.struct(F.lit(label).alias("label"), step.alias("step"), value.alias("y_true"))

        return F.zip_with(steps, col(f"out_{label}"), pair)

    all_cells = F.flatten(F.array(*(cells(c) for c in settings.label_columns)))
    return windows.select("start_pos", F.inline(all_cells))
