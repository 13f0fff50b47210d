"""Windows and forecasts over the hourly series of all events."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.evaluation import regression_metrics
from millrace.operators.forecast import (
    SweepConfig, fit_linear, forecast_ahead, future_timestamps, model_sweep, persistence_forecast,
    seasonal_forecast, solve_linear, window_moments,
)
from millrace.operators.missing import FillMissing, FillSettings
from millrace.operators.sampling import TimeResample
from millrace.operators.scaling import Scale, ScaleSettings
from millrace.operators.splitting import Ratios, TimeSplit
from millrace.operators.windows import WindowSettings, label_matrix, make_windows
from millrace.session import materialize
from millrace.sources.tables import to_result_frame
from queries.registry import query, r6, table

SETTINGS = WindowSettings(label_columns=("value",), feature_columns=("value", "user_id"))


def _windows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value", "user_id")
    return make_windows(events, SETTINGS, "ts", "event_id")


OVER = "OVER (ORDER BY ts, event_id)"
AHEAD = f"""ahead AS (
  SELECT {", ".join(f"lead(value, {i}) {OVER} AS v{i}" for i in (*range(6), *range(25, 30)))},
         {", ".join(f"lead(user_id, {i}) {OVER} AS u{i}" for i in range(6))},
         row_number() {OVER} - 1 AS start_pos, ts AS start_time, count(*) OVER () AS n FROM events),
w AS (SELECT * FROM ahead WHERE start_pos + 29 < n)"""


@query(
    "make_windows",
    f"""WITH {AHEAD} SELECT start_pos, start_time,
          {", ".join(f"round(v{i}, 6) AS v{i}" for i in (*range(6), *range(25, 30)))},
          {", ".join(f"u{i}::DOUBLE AS u{i}" for i in range(6))} FROM w""",
)
def _(spark, sf_dir):
    windows = _windows(spark, sf_dir)
    values = [r6(F.get("in_value", F.lit(i))).alias(f"v{i}") for i in range(6)]
    values += [F.get("in_user_id", F.lit(i)).alias(f"u{i}") for i in range(6)]
    values += [r6(F.get("out_value", F.lit(i))).alias(f"v{25 + i}") for i in range(5)]
    return windows.select("start_pos", "start_time", *values)


STEPS = "(VALUES (1), (2), (3), (4), (5)) AS k(step)"
TRUE = "CASE step WHEN 1 THEN v25 WHEN 2 THEN v26 WHEN 3 THEN v27 WHEN 4 THEN v28 ELSE v29 END"


@query(
    "label_matrix",
    f"""WITH {AHEAD} SELECT start_pos, 'value' AS label, step, round({TRUE}, 6) AS y_true FROM w, {STEPS}""",
)
def _(spark, sf_dir):
    return label_matrix(_windows(spark, sf_dir), SETTINGS).withColumn("y_true", r6(F.col("y_true")))


def _long(df):
    return df.withColumns({"y_true": r6(F.col("y_true")), "y_pred": r6(F.col("y_pred"))})


@query(
    "forecast_persistence",
    f"""WITH {AHEAD} SELECT start_pos, 'value' AS label, step, round({TRUE}, 6) AS y_true,
          round(v5, 6) AS y_pred FROM w, {STEPS}""",
)
def _(spark, sf_dir):
    return _long(persistence_forecast(_windows(spark, sf_dir), SETTINGS))


INPUTS = [*(f"v{i}" for i in range(6)), *(f"u{i}" for i in range(6))]


def _residual_sql(step: int, place: int) -> str:
    """Least squares leaves residuals that no input explains: their inner product with each is 0."""
    return f"""SELECT 'value' AS label, {step} AS step, {place} AS input, count(*) AS n,
        round(sqrt(avg({INPUTS[place]}::DOUBLE ** 2)), 6) AS norm, 0.0::DOUBLE AS mean_residual, 0.0::DOUBLE AS explained FROM w"""


@query(
    "forecast_baseline",
    f"WITH {AHEAD} " + " UNION ALL ".join(_residual_sql(s, p) for s in range(1, 6) for p in range(12)),
)
def _(spark, sf_dir):
    windows = materialize(_windows(spark, sf_dir))
    predicted = fit_linear(windows, SETTINGS).predict(windows)
    inputs = windows.select("start_pos", F.posexplode(F.concat("in_value", "in_user_id")).alias("input", "x"))
    residual = F.col("y_pred") - F.col("y_true")
    size = F.sqrt(F.avg(F.col("x") ** 2)) * F.sqrt(F.avg(F.col("y_true") ** 2))
    judged = predicted.join(inputs, "start_pos").groupBy("label", "step", "input").agg(
        F.count("y_pred").alias("n"),
        r6(F.sqrt(F.avg(F.col("x") ** 2))).alias("norm"),
        F.abs(r6(F.avg(residual))).alias("mean_residual"),
        F.abs(r6(F.avg(residual * F.col("x")) / size)).alias("explained"),
    )
    return judged


SINGLE = WindowSettings(("value",), ("value",), input_width=1, label_width=1, shift=1)
SWEEP = f"""WITH pair AS (
  SELECT value AS x, lead(value) {OVER} AS y, row_number() {OVER} - 1 AS pos, count(*) OVER () - 1 AS n FROM events),
cut AS (SELECT *, n * 7 // 10 AS edge FROM pair WHERE pos < n),
known AS (SELECT avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(x, y) AS c FROM cut WHERE pos < edge - 2),
slope(config, w) AS (
  SELECT 'plain', c / vx FROM known UNION ALL SELECT 'ridge', c / (vx * 1.5) FROM known
  UNION ALL SELECT 'lasso', sign(c) * greatest(abs(c) / sqrt(vx) - 0.1, 0) / sqrt(vx) FROM known),
judged AS (SELECT config, my + w * (x - mx) - y AS gap FROM cut, known, slope WHERE pos >= edge)
SELECT config, count(*) AS n, round(avg(abs(gap)), 6) AS mae, round(sqrt(avg(gap * gap)), 6) AS rmse FROM judged GROUP BY config"""


CONFIGS = [SweepConfig("plain"), SweepConfig("ridge", 0.5), SweepConfig("lasso", 0.1, 1.0)]


def _parts(windows, settings):
    """Seven tenths to learn from and the rest to judge; windows that reach past the cut are in neither, so that no
    label is seen in training."""
    cut = windows.count() * 7 // 10
    return windows.where(F.col("start_pos") < cut - settings.total), windows.where(F.col("start_pos") >= cut)


@query("model_sweep_single", SWEEP)
def _(spark, sf_dir):
    """One input, where the three penalties have closed forms."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    windows = materialize(make_windows(events, SINGLE, "ts", "event_id"))
    found = model_sweep(*_parts(windows, SINGLE), SINGLE, CONFIGS)
    return found.select("config", "n", r6(F.col("mae")).alias("mae"), r6(F.col("rmse")).alias("rmse"))


def _conditions_sql(config: str, step: int, place: int) -> str:
    """What the optimum of each penalty leaves: residuals without mean, and per input no slope that could be followed."""
    return f"""SELECT '{config}' AS config, {step} AS step, {place} AS input, count(*) FILTER (start_pos < edge - 30) AS n_train,
        count(*) FILTER (start_pos >= edge) * 5 AS n_judged, round(stddev_pop({INPUTS[place]}) FILTER (start_pos < edge - 30), 6) AS spread,
        0.0::DOUBLE AS mean_residual, 0.0::DOUBLE AS slope_left FROM cut"""


@query(
    "model_sweep",
    f"""WITH {AHEAD}, cut AS (SELECT *, count(*) OVER () * 7 // 10 AS edge FROM w)
        {" UNION ALL ".join(_conditions_sql(c.name, s, p) for c in CONFIGS for s in range(1, 6) for p in range(12))}""",
)
def _(spark, sf_dir):
    """Three penalties over all inputs and steps of the full windows, solved from one set of moments and judged on the
    later windows. The optimum is proved by its conditions: with standardized inputs, the mean product of residual and
    input is the ridge share of the weight plus the lasso share with its sign, or less where the weight is 0."""
    windows = materialize(_windows(spark, sf_dir))
    train, validation = _parts(windows, SETTINGS)
    judged = model_sweep(train, validation, SETTINGS, CONFIGS).where("status = 'ok' and rmse > 0")
    moments, count = window_moments(train, SETTINGS), train.count()
    spread = (moments.second.diagonal()[:12] ** 0.5).tolist()
    inputs = train.select("start_pos", F.posexplode(F.concat("in_value", "in_user_id")).alias("input", "x"))
    sigma, mean = (F.get(F.array(*map(F.lit, v)), F.col("input")) for v in (spread, moments.mean[:12].tolist()))
    found = None
    for config in CONFIGS:
        model = solve_linear(moments, SETTINGS, config.reg, config.elastic)
        weights = [(step + 1, place, w * spread[place]) for step, (_, own) in enumerate(model.weights["value"]) for place, w in enumerate(own)]
        scaled = F.broadcast(spark.createDataFrame(weights, "step int, input int, u double"))
        residual = F.col("y_true") - F.col("y_pred")
        slopes = model.predict(train).join(inputs, "start_pos").groupBy("step", "input").agg(
            F.avg(residual * (F.col("x") - mean) / sigma).alias("slope"), F.avg(residual).alias("rest"), F.stddev_pop("x").alias("spread"))
        u, lasso = F.col("u"), F.lit(config.reg * config.elastic)
        bound = F.when(u == 0, F.greatest(F.abs(F.col("slope")) - lasso, F.lit(0.0))).otherwise(
            F.abs(F.col("slope") - config.reg * (1 - config.elastic) * u - lasso * F.signum(u)))
        own = slopes.join(scaled, ["step", "input"]).select(
            F.lit(config.name).alias("config"), "step", "input", F.lit(count).cast("long").alias("n_train"), r6(F.col("spread")).alias("spread"),
            F.abs(r6(F.col("rest"))).alias("mean_residual"), r6(bound).alias("slope_left"))
        found = own if found is None else found.union(own)
    return found.join(F.broadcast(judged.select("config", F.col("n").alias("n_judged"))), "config")


HOURLY = WindowSettings(label_columns=("value", "users"), feature_columns=("value", "users"))
GRID = """hours AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS ts, avg(value) AS value, avg(user_id) AS users FROM events GROUP BY 1)"""


def _hourly(spark, sf_dir):
    """The events as a regular series of hours, hours without events included."""
    events = table(spark, sf_dir, "events").select("ts", "value", F.col("user_id").cast("double").alias("users"))
    grid = TimeResample("ts", "1H", keep_empty=True).apply(events)
    return grid.withColumn("hour", F.unix_seconds(F.col("ts").cast("timestamp")))


@query(
    "forecast_ahead",
    f"""WITH {GRID}, tail AS (SELECT * FROM hours ORDER BY ts DESC LIMIT 1)
        SELECT label, step::INT AS step, ts + to_hours((19 + step)::INT) AS ts,
               round(CASE label WHEN 'value' THEN value ELSE users END, 6) AS y_pred
        FROM tail, generate_series(1, 5) AS g(step), (VALUES ('value'), ('users')) AS l(label)""",
)
def _(spark, sf_dir):
    """Behind the last row: two labels, the interval measured on the series."""
    ahead = forecast_ahead(_hourly(spark, sf_dir), HOURLY, "ts", "hour", lambda w: persistence_forecast(w, HOURLY))
    return ahead.withColumn("y_pred", r6(F.col("y_pred")))


def _run_sql(label: str, step: int) -> str:
    return f"""SELECT '{label}' AS label, {step} AS step, count(y) AS n, round(avg(abs(x - y)), 6) AS mae FROM (
      SELECT {label} AS x, lead({label}, {19 + step}) OVER (ORDER BY pos) AS y, lead({label}, 24) OVER (ORDER BY pos) AS e, pos, low, n FROM test)
      WHERE pos >= low + 5 AND pos + 24 < n"""


@query(
    "weather_run",
    f"""WITH {GRID}, span AS (SELECT unnest(generate_series((SELECT min(ts) FROM hours), (SELECT max(ts) FROM hours), INTERVAL '1 hour')) AS ts),
        whole AS (SELECT s.ts, last_value(h.value IGNORE NULLS) OVER o AS value, last_value(h.users IGNORE NULLS) OVER o AS users,
                         row_number() OVER (ORDER BY s.ts) - 1 AS pos, count(*) OVER () AS n
                  FROM span s LEFT JOIN hours h ON s.ts = h.ts WINDOW o AS (ORDER BY s.ts)),
        cut AS (SELECT *, floor(n * 0.6 + 0.5) + floor(n * 0.2 + 0.5) AS low FROM whole),
        test AS (SELECT * FROM cut WHERE pos >= low)
        {" UNION ALL ".join(_run_sql(label, step) for label in ("value", "users") for step in range(1, 6))}""",
)
def _(spark, sf_dir):
    """The whole run: resample, fill, split, scale by the training part, window, forecast, unscale, judge."""
    ready = FillMissing(FillSettings(rules={"value": "ffill", "users": "ffill"}, time="ts", row_id="hour"))
    series = materialize(ready.fit_transform(_hourly(spark, sf_dir)))
    split = TimeSplit(Ratios(0.6, 0.2, 0.2)).apply(series, "ts", "hour")
    train, test = (split.where(F.col("split") == part).drop("split") for part in ("train", "test"))
    standard = ScaleSettings.from_dict({"transformers": [{"standard": {"columns": ["value", "users"]}}]}, only_listed=True)
    scaler = Scale(standard).fit(train)
    windows = make_windows(scaler.transform(test), HOURLY, "ts", "hour")
    judged = []
    for label in HOURLY.label_columns:
        own = persistence_forecast(windows, HOURLY).where(F.col("label") == label)
        back = scaler.inverse(own, {"y_pred": label, "y_true": label})
        judged.append(regression_metrics(back, "y_true", "y_pred", ["label", "step"]))
    return judged[0].unionByName(judged[1]).select("label", "step", "n", r6(F.col("mae")).alias("mae"))


@query(
    "future_timestamps",
    """SELECT CAST(step AS INT) AS step, m + to_minutes(10 * (step + 19)::INT) AS ts
       FROM (SELECT max(ts) AS m FROM events), generate_series(1, 5) AS g(step)""",
)
def _(spark, sf_dir):
    return future_timestamps(table(spark, sf_dir, "events"), "ts", 600, 5, 24)


@query(
    "to_result_frame",
    f"""WITH {GRID}, tail AS (SELECT * FROM hours ORDER BY ts DESC LIMIT 1)
        SELECT ts + to_hours((19 + step)::INT) AS ts, round(value, 6) AS value, round(users, 6) AS users
        FROM tail, generate_series(1, 5) AS g(step)""",
)
def _(spark, sf_dir):
    """Forecasts of both labels beside the times they are for."""
    ahead = forecast_ahead(_hourly(spark, sf_dir), HOURLY, "ts", "hour", lambda w: persistence_forecast(w, HOURLY), 3600)
    wide = ahead.groupBy("ts").pivot("label", list(HOURLY.label_columns)).agg(F.first("y_pred"))
    return to_result_frame(wide.select("ts", *(r6(F.col(c)).alias(c) for c in HOURLY.label_columns)), "ts", ["value", "users"], view="forecasts")


@query(
    "forecast_same_hour",
    f"""WITH {GRID}, span AS (SELECT unnest(generate_series((SELECT min(ts) FROM hours), (SELECT max(ts) FROM hours), INTERVAL '1 hour')) AS ts),
        whole AS (SELECT s.ts, h.value, h.users, row_number() OVER (ORDER BY s.ts) - 1 AS start_pos, count(*) OVER () AS n
                  FROM span s LEFT JOIN hours h ON s.ts = h.ts),
        {", ".join(f"l{k} AS (SELECT start_pos, n, lead(value, {24 + k}) OVER o AS tv, lead(value, {k}) OVER o AS pv, lead(users, {24 + k}) OVER o AS tu, lead(users, {k}) OVER o AS pu FROM whole WINDOW o AS (ORDER BY start_pos))" for k in range(1, 6))}
        {" UNION ALL ".join(f"SELECT start_pos, '{label}' AS label, {k} AS step, round(t{label[0]}, 6) AS y_true, round(p{label[0]}, 6) AS y_pred FROM l{k} WHERE start_pos + 29 < n" for label in ("value", "users") for k in range(1, 6))}""",
)
def _(spark, sf_dir):
    """The same hour a day before, on the regular series."""
    windows = make_windows(_hourly(spark, sf_dir), HOURLY, "ts", "hour")
    return _long(seasonal_forecast(windows, HOURLY, period=24))


@query(
    "unscale_forecast",
    f"""WITH {AHEAD} SELECT start_pos, 'value' AS label, step, round(v5, 6) AS y_pred FROM w, {STEPS}""",
)
def _(spark, sf_dir):
    """Scale, window, forecast in scaled units, and bring the forecasts back to original units."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value", "user_id")
    settings = ScaleSettings.from_dict({"transformers": [{"standard": {"columns": ["value"]}}]}, only_listed=True)
    scaler = Scale(settings).fit(events)
    windows = make_windows(scaler.transform(events), SETTINGS, "ts", "event_id")
    forecast = persistence_forecast(windows, SETTINGS).drop("y_true")
    return scaler.inverse(forecast, {"y_pred": "value"}).withColumn("y_pred", r6(F.col("y_pred")))


@query(
    "hourly_clipped",
    """WITH g AS (SELECT time_bucket(INTERVAL '6 hours', ts) AS ts, avg(value) AS value FROM events GROUP BY 1),
            b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM g),
            c AS (SELECT ts, value, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM g, b)
       SELECT ts, round(CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END, 6) AS value,
              CAST(value < lo OR value > hi AS INT) AS is_outlier_value FROM c""",
)
def flagship(spark, sf_dir):
    """Six-hour means of all events with their outliers clipped and marked."""
    from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings

    events = table(spark, sf_dir, "events").select("ts", "value")
    grid = TimeResample("ts", "6H").apply(events)
    rule = OutlierRule("value", "iqr", "clip", threshold=1.5)
    clipped = Outliers(OutlierSettings((rule,), ("value",))).fit_transform(grid)
    return clipped.withColumn("value", r6(F.col("value")))
