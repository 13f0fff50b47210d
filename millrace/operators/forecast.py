"""Forecasts over windows: two naive baselines, linear models, a sweep, future time stamps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, epoch_micros, from_epoch_micros, number, type_of
from millrace.operators.evaluation import regression_metrics
from millrace.operators.windows import WindowSettings
from millrace.plans.order import steps_in_order
from millrace.plans.quantiles import quantiles
from millrace.session import materialize


def _long(windows: DataFrame, settings: WindowSettings, forecasts: dict[str, list]) -> DataFrame:
    """``(start_pos, label, step, y_true, y_pred)`` from one forecast expression per label and step."""
    cells = [
        F.struct(
            F.lit(label).alias("label"),
            F.lit(step + 1).alias("step"),
            (F.get(col(f"out_{label}"), F.lit(step)) if f"out_{label}" in windows.columns
             else F.lit(None).cast("double")).alias("y_true"),
            forecast.alias("y_pred"),
        )
        for label, steps in forecasts.items()
        for step, forecast in enumerate(steps)
    ]
    return windows.select("start_pos", F.inline(F.array(*cells)))


def persistence_forecast(windows: DataFrame, settings: WindowSettings) -> DataFrame:
    """Every step is the last input value of its label, which must be a feature too."""
    last = settings.input_width - 1
    return _long(
        windows,
        settings,
        {
            c: [F.get(col(f"in_{c}"), F.lit(last))] * settings.label_width
            for c in settings.label_columns
        },
    )


def seasonal_forecast(windows: DataFrame, settings: WindowSettings, period: int) -> DataFrame:
    """Every step is the input value one period earlier (24 hourly steps: the same hour a day before);
    NULL where that lies outside the inputs."""
    def earlier(label: str, step: int):
        place = settings.label_start + step - period
        if 0 <= place < settings.input_width:
            return F.get(col(f"in_{label}"), F.lit(place))
        return F.lit(None).cast("double")

    return _long(
        windows,
        settings,
        {c: [earlier(c, i) for i in range(settings.label_width)] for c in settings.label_columns},
    )


@dataclass(frozen=True)
class LinearForecast:
    """Coefficients per label and step over all input values of a window."""

    settings: WindowSettings
    weights: dict[str, list[tuple[float, list[float]]]]

    def predict(self, windows: DataFrame) -> DataFrame:
        """A plain expression: intercept plus the weighted input values."""
        inputs = F.concat(*(col(f"in_{c}") for c in self.settings.feature_columns))
        forecasts = {}
        for label, steps in self.weights.items():
            forecasts[label] = [
                F.aggregate(
                    F.zip_with(inputs, F.array(*map(F.lit, weights)), lambda x, w: x * w),
                    F.lit(intercept),
                    lambda total, part: total + part,
                )
                for intercept, weights in steps
            ]
        return _long(windows, self.settings, forecasts)


@dataclass(frozen=True)
class Moments:
    """Count, means and centred second moments of all input and label values of complete windows."""

    n: int
    mean: np.ndarray
    second: np.ndarray


def window_moments(windows: DataFrame, settings: WindowSettings) -> Moments:
    """Everything that a linear model of any label, step and penalty needs, from two passes.

    Each task adds up one small matrix in array code; the matrices are summed cell by cell, so the driver
    gets as many numbers as one of them has. Windows with a missing value are left out.
    """
    cells = [F.get(col(f"in_{c}"), F.lit(j)) for c in settings.feature_columns for j in range(settings.input_width)]
    cells += [F.get(col(f"out_{c}"), F.lit(j)) for c in settings.label_columns for j in range(settings.label_width)]
    names = [f"v{i}" for i in range(len(cells))]
    flat = windows.select(*(cell.cast("double").alias(name) for cell, name in zip(cells, names, strict=True))).dropna()
    row = flat.agg(F.count(F.lit(1)).alias("n"), *(F.avg(name).alias(name) for name in names)).first()
    width = len(names)
    if not row["n"]:
        return Moments(0, np.zeros(width), np.zeros((width, width)))
    mean = np.array([row[name] for name in names])

    def add_up(batches):
        total = np.zeros((width, width))
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - mean
            total += values.T @ values
        places = pa.array(np.arange(width * width, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel())], names=["place", "part"])

    parts = flat.mapInArrow(add_up, "place long, part double").groupBy("place").agg(F.sum("part").alias("total"))
    second = np.zeros(width * width)
    for cell in parts.collect():
        second[cell["place"]] = cell["total"]
    return Moments(row["n"], mean, second.reshape(width, width) / row["n"])


def solve_linear(moments: Moments, settings: WindowSettings, reg: float = 0.0, elastic: float = 0.0) -> LinearForecast:
    """The weights with the least ``mean(residual²) / 2 + reg · penalty`` for each label and step.

    The penalty is ``(1 - elastic) · Σ(σw)² / 2 + elastic · Σ|σw|`` over the inputs, σ their deviations.
    """
    if reg < 0 or not 0 <= elastic <= 1:
        raise ValueError("regParam must not be negative, and elasticNetParam must lie between 0 and 1")
    if not moments.n:
        raise ValueError("no complete window to learn from")
    inputs = len(settings.feature_columns) * settings.input_width
    spread = np.sqrt(np.diag(moments.second)[:inputs])
    scale = np.where(spread > 0, spread, 1.0)
    gram = moments.second[:inputs, :inputs] / np.outer(scale, scale)
    weights: dict[str, list] = {}
    place = inputs
    for label in settings.label_columns:
        weights[label] = []
        for _ in range(settings.label_width):
            target = moments.second[:inputs, place] / scale
            if elastic:
                scaled = _coordinate_descent(gram, target, reg * (1 - elastic), reg * elastic)
            else:
                scaled = np.linalg.lstsq(gram + reg * np.eye(inputs), target, rcond=1e-12)[0]
            own = np.where(spread > 0, scaled / scale, 0.0)
            weights[label].append((float(moments.mean[place] - own @ moments.mean[:inputs]), own.tolist()))
            place += 1
    return LinearForecast(settings, weights)


def _coordinate_descent(gram: np.ndarray, target: np.ndarray, ridge: float, lasso: float, rounds: int = 10_000) -> np.ndarray:
    weights = np.zeros(len(target))
    for _ in range(rounds):
        largest = 0.0
        for j in range(len(weights)):
            free = target[j] - gram[j] @ weights + gram[j, j] * weights[j]
            new = np.sign(free) * max(abs(free) - lasso, 0.0) / (gram[j, j] + ridge) if gram[j, j] + ridge > 0 else 0.0
            largest, weights[j] = max(largest, abs(new - weights[j])), new
        if largest < 1e-12:
            break
    return weights


def fit_linear(
    windows: DataFrame, settings: WindowSettings, reg: float = 0.0, elastic: float = 0.0
) -> LinearForecast:
    """One linear regression per label and step over all input values of a window."""
    return solve_linear(window_moments(windows, settings), settings, reg, elastic)


@dataclass(frozen=True)
class SweepConfig:
    name: str
    reg: float = 0.0
    elastic: float = 0.0


def model_sweep(
    train: DataFrame,
    validation: DataFrame,
    settings: WindowSettings,
    configs: list[SweepConfig],
) -> DataFrame:
    """Solve all configurations from one set of moments and compare them on the validation windows.

    A failing configuration is reported, not raised.
    """
    spark, moments = train.sparkSession, window_moments(train, settings)

    def run(config: SweepConfig) -> tuple:
        try:
            model = solve_linear(moments, settings, config.reg, config.elastic)
            row = regression_metrics(model.predict(validation), "y_true", "y_pred").first()
            return (config.name, "ok", row["n"], row["mae"], row["rmse"], None)
        except Exception as error:
            return (config.name, "failed", None, None, None, f"{type(error).__name__}: {error}")

    rows = [run(config) for config in configs]
    return spark.createDataFrame(
        rows, "config string, status string, n long, mae double, rmse double, error string"
    )


def last_inputs(df: DataFrame, settings: WindowSettings, time: str, row_id: str) -> DataFrame:
    """The input window that ends with the last row, in the form of :func:`make_windows` without labels;
    ``start_pos`` is 0 and ``last_time`` the time of the last row. Empty if there are too few rows."""
    used = list(dict.fromkeys(settings.feature_columns))
    narrow = df.select(col(time).alias("__t"), col(row_id).alias("__id"), *(number(df, c).alias(c) for c in used))
    tail = narrow.orderBy(F.desc("__t"), F.desc("__id")).limit(settings.input_width)
    cells = F.array_sort(F.collect_list(F.struct("__t", "__id", *(col(c) for c in used))))
    gathered = tail.agg(cells.alias("cells")).where(F.size("cells") == settings.input_width)
    arrays = [F.col("cells").getField(c).alias(f"in_{c}") for c in used]
    last = F.element_at("cells", -1)["__t"].alias("last_time")
    return gathered.select(F.lit(0).cast("long").alias("start_pos"), last, *arrays)


def interval_micros(df: DataFrame, time: str, row_id: str) -> int:
    """The sampling interval: the median step between the times of neighbouring rows."""
    moments = df.select(epoch_micros(df, time).alias("place")).where("place is not null")
    steps = materialize(steps_in_order(moments.withColumn("x", F.col("place")), "place", "x"))
    return int(quantiles(steps, {"s": (F.col("step").cast("double"), [0.5])})["s"][0])


def forecast_ahead(
    df: DataFrame, settings: WindowSettings, time: str, row_id: str, predict, interval_seconds: float | None = None
) -> DataFrame:
    """``(label, step, time, y_pred)`` for the steps behind the last row of the table.

    ``predict`` turns windows into forecasts (:func:`persistence_forecast` with its settings, or the
    ``predict`` of a fitted model). Without an interval the table's own is measured.
    """
    window = last_inputs(df, settings, time, row_id)
    micros = interval_micros(df, time, row_id) if interval_seconds is None else int(interval_seconds * 1_000_000)
    last = F.broadcast(window.select(epoch_micros(window, "last_time").alias("last")))
    moment = F.col("last") + (F.col("step") + F.lit(settings.shift - settings.label_width)) * F.lit(micros)
    ahead = predict(window).join(last)  # one row: the end of the table
    return ahead.select("label", "step", from_epoch_micros(moment, type_of(df, time)).alias(time), "y_pred")


def future_timestamps(
    df: DataFrame, time: str, interval_seconds: int, label_width: int, shift: int
) -> DataFrame:
    """Time stamps of the forecast steps after the last row: steps ``shift - label_width + 1`` to
    ``shift`` of the sampling interval."""
    last = df.agg(F.max(epoch_micros(df, time)).alias("last"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(label_width))).alias("step")
    steps_ahead = F.col("step").cast("long") + F.lit(shift - label_width)
    ahead = steps_ahead * F.lit(interval_seconds * 1_000_000)
    moment = from_epoch_micros(F.col("last") + ahead, type_of(df, time))
    return last.select("last", steps).select("step", moment.alias(time))
