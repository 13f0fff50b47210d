"""Forecasts for many series in one table: a linear model per entity, learned and applied as tables.

There may be as many entities as rows allow, so nothing per entity goes through the driver. Tasks add
up one small matrix of moments for each entity they meet; these partial moments are merged by entity,
and the entities that have very many of them (one may hold a third of all windows) are merged in
steps of at most ``MERGED_AT_ONCE``. Weights are one row per entity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import col, type_of
from millrace.operators.evaluation import regression_metrics
from millrace.operators.forecast import Moments, SweepConfig, solve_linear
from millrace.operators.windows import WindowSettings
from millrace.session import materialize

MERGED_AT_ONCE = 1_000
#: Entities up to this number have their weights broadcast; it is counted first.
BROADCAST_ENTITIES = 100_000


def _merge(n: np.ndarray, mean: np.ndarray, second: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """One set of moments from many: total, mean, and sums of products about that mean."""
    total = n.sum()
    middle = n @ mean / total
    away = mean - middle
    return int(total), middle, second.sum(0) + ((away * n[:, None]).T @ away).ravel()


def entity_moments(windows: DataFrame, settings: WindowSettings, entity: str) -> DataFrame:
    """``entity, n, mean, second``: count, means and sums of centred products of all input and label values of
    each entity's complete windows. Windows with a missing value are left out."""
    parts = [F.col(f"`in_{c}`") for c in settings.feature_columns] + [F.col(f"`out_{c}`") for c in settings.label_columns]
    width = len(settings.feature_columns) * settings.input_width + len(settings.label_columns) * settings.label_width
    cells = F.concat(*(F.transform(p, lambda x: x.cast("double")) for p in parts))
    flat = windows.select(col(entity).alias("entity"), cells.alias("cells")).where(
        (F.size("cells") == width) & ~F.exists("cells", lambda x: x.isNull() | F.isnan(x)))
    kind = type_of(windows, entity)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0).dictionary_encode("encode")
            codes = names.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)[order]
            starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
            n = np.diff(np.append(starts, len(codes)))
            mean = np.add.reduceat(values, starts) / n[:, None]
            away = values - np.repeat(mean, n, axis=0)
            second = np.stack([a.T @ a for a in np.split(away, starts[1:])]).reshape(len(n), -1)
            ends = lambda k: pa.array(np.arange(0, (len(n) + 1) * k, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array(codes[order][starts])), pa.array(n),
                 pa.ListArray.from_arrays(ends(width), pa.array(mean.ravel())),
                 pa.ListArray.from_arrays(ends(width * width), pa.array(second.ravel()))],
                names=["entity", "n", "mean", "second"])

    array = T.ArrayType(T.DoubleType())
    schema = T.StructType([T.StructField("entity", kind), T.StructField("n", T.LongType()),
                           T.StructField("mean", array), T.StructField("second", array)])
    partial = materialize(flat.mapInArrow(add_up, schema))

    def merged(pdf):
        n, mean, second = _merge(pdf["n"].to_numpy(), np.stack(pdf["mean"].to_list()), np.stack(pdf["second"].to_list()))
        return pdf.iloc[:1].assign(n=n, mean=[mean.tolist()], second=[second.tolist()])[["entity", "n", "mean", "second"]]

    while True:
        crowded = partial.groupBy("entity").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > MERGED_AT_ONCE)
        if crowded.isEmpty():
            return partial.groupBy("entity").applyInPandas(merged, schema)
        crowded = crowded.withColumnRenamed("entity", "crowd")
        turned = partial.join(F.broadcast(crowded), F.col("entity").eqNullSafe(F.col("crowd")), "left")
        pieces = F.coalesce(F.ceil(F.col("m") / F.lit(MERGED_AT_ONCE // 2)), F.lit(1))
        piece = F.pmod(F.xxhash64("mean", "second", "n"), pieces)
        partial = materialize(turned.withColumn("piece", piece).drop("m", "crowd").groupBy("entity", "piece").applyInPandas(merged, schema))


@dataclass(frozen=True)
class EntityForecast:
    """``table``: one row per entity with ``n`` windows and, for each label and step in order, intercept and weights."""

    settings: WindowSettings
    entity: str
    table: DataFrame

    def predict(self, windows: DataFrame) -> DataFrame:
        """``(entity, start_pos, label, step, y_true, y_pred)``; entities without a model are forecast as NULL."""
        s, models = self.settings, self.table.withColumnRenamed(self.entity, "__of").drop("n")
        small = models.limit(BROADCAST_ENTITIES + 1).count() <= BROADCAST_ENTITIES
        joined = windows.join(F.broadcast(models) if small else models, col(self.entity).eqNullSafe(F.col("__of")), "left")
        inputs = F.concat(*(col(f"in_{c}") for c in s.feature_columns))
        cells = []
        for place, (label, step) in enumerate((c, i) for c in s.label_columns for i in range(s.label_width)):
            own = F.get("weights", F.lit(place))
            total = F.aggregate(F.zip_with(inputs, own["w"], lambda x, w: x * w), own["intercept"], lambda a, b: a + b)
            true = F.get(col(f"out_{label}"), F.lit(step)) if f"out_{label}" in windows.columns else F.lit(None).cast("double")
            cells.append(F.struct(F.lit(label).alias("label"), F.lit(step + 1).alias("step"), true.alias("y_true"), total.alias("y_pred")))
        return joined.select(col(self.entity), "start_pos", F.inline(F.array(*cells)))


def solve_by_entity(moments: DataFrame, settings: WindowSettings, entity: str, reg: float = 0.0, elastic: float = 0.0) -> EntityForecast:
    """A linear model per entity from its moments, solved in the tasks that hold them."""
    if reg < 0 or not 0 <= elastic <= 1:
        raise ValueError("regParam must not be negative, and elasticNetParam must lie between 0 and 1")
    weights = pa.list_(pa.struct([("intercept", pa.float64()), ("w", pa.list_(pa.float64()))]))

    def solve(n: pa.Array, mean: pa.Array, second: pa.Array) -> pa.Array:
        found = []
        for count, m, cells in zip(n.to_pylist(), mean, second, strict=True):
            middle = m.values.to_numpy()
            own = Moments(count, middle, cells.values.to_numpy().reshape(len(middle), -1) / count)
            solved = solve_linear(own, settings, reg, elastic).weights
            found.append([{"intercept": a, "w": w} for label in settings.label_columns for a, w in solved[label]])
        return pa.array(found, weights)

    solve.__annotations__ = {"n": pa.Array, "mean": pa.Array, "second": pa.Array, "return": pa.Array}
    solver = F.arrow_udf(solve, "array<struct<intercept:double,w:array<double>>>")
    table = materialize(moments.select(F.col("entity").alias(entity), "n", solver("n", "mean", "second").alias("weights")))
    return EntityForecast(settings, entity, table)


def fit_by_entity(windows: DataFrame, settings: WindowSettings, entity: str, reg: float = 0.0, elastic: float = 0.0) -> EntityForecast:
    """One linear regression per entity, label and step over all input values of a window."""
    return solve_by_entity(entity_moments(windows, settings, entity), settings, entity, reg, elastic)


def sweep_by_entity(
    train: DataFrame, validation: DataFrame, settings: WindowSettings, entity: str, configs: list[SweepConfig]
) -> DataFrame:
    """``(entity, config, n, mae, rmse, best)``: every configuration solved from one set of moments per entity and
    judged on its validation windows; the one of least ``rmse`` (to nine places) is best, the first in alphabet among equals."""
    moments = materialize(entity_moments(train, settings, entity))
    judged = None
    for config in configs:
        model = solve_by_entity(moments, settings, entity, config.reg, config.elastic)
        row = regression_metrics(model.predict(validation), "y_true", "y_pred", [entity]).select(
            col(entity), F.lit(config.name).alias("config"), "n", "mae", "rmse")
        judged = row if judged is None else judged.union(row)
    judged = materialize(judged)
    least = judged.where("rmse is not null").groupBy(col(entity).alias("__of")).agg(F.min(F.struct(F.round("rmse", 9).alias("r"), "config"))["config"].alias("__best"))
    joined = judged.join(least, col(entity).eqNullSafe(F.col("__of")), "left")
    return joined.select(col(entity), "config", "n", "mae", "rmse", F.coalesce(F.col("config") == F.col("__best"), F.lit(False)).alias("best"))
