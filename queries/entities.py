"""Windows and forecasts for every user's own series of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.entities import fit_by_entity, sweep_by_entity
from millrace.operators.forecast import SweepConfig
from millrace.operators.windows import WindowSettings, make_windows
from millrace.session import materialize
from queries.registry import query, r6, table

SETTINGS = WindowSettings(("value",), ("value",), input_width=4, label_width=2, shift=3)


def _windows(spark, sf_dir, settings=SETTINGS):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value", "user_id")
    return make_windows(events, settings, "ts", "event_id", entity="user_id")


OVER = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"
AHEAD = f"""ahead AS (
  SELECT user_id, {", ".join(f"lead(value, {i}) {OVER} AS v{i}" for i in range(7))},
         row_number() {OVER} - 1 AS start_pos, ts AS start_time, count(*) OVER (PARTITION BY user_id) AS n FROM events),
w AS (SELECT * FROM ahead WHERE start_pos + 6 < n)"""


@query(
    "windows_by_entity",
    f"""WITH {AHEAD} SELECT user_id, start_pos, start_time, {", ".join(f"round(v{i}, 6) AS v{i}" for i in (0, 1, 2, 3, 5, 6))} FROM w""",
)
def _(spark, sf_dir):
    windows = _windows(spark, sf_dir)
    values = [r6(F.get("in_value", F.lit(i))).alias(f"v{i}") for i in range(4)]
    values += [r6(F.get("out_value", F.lit(i))).alias(f"v{5 + i}") for i in range(2)]
    return windows.select("user_id", "start_pos", "start_time", *values)


def _residual_sql(step: int, place: int) -> str:
    return f"""SELECT user_id, 'value' AS label, {step} AS step, {place} AS input, count(*) AS n,
        round(sqrt(avg(v{place} ** 2)), 6) AS norm, 0.0::DOUBLE AS mean_residual, 0.0::DOUBLE AS explained FROM w GROUP BY user_id"""


@query(
    "forecast_by_entity",
    f"WITH {AHEAD} " + " UNION ALL ".join(_residual_sql(s, p) for s in (1, 2) for p in range(4)),
)
def _(spark, sf_dir):
    """One least squares fit per user; its residuals have no mean and are explained by no input, user by user."""
    windows = materialize(_windows(spark, sf_dir))
    predicted = fit_by_entity(windows, SETTINGS, "user_id").predict(windows)
    inputs = windows.select("user_id", "start_pos", F.posexplode("in_value").alias("input", "x"))
    residual = F.col("y_pred") - F.col("y_true")
    size = F.sqrt(F.avg(F.col("x") ** 2)) * F.sqrt(F.avg(F.col("y_true") ** 2))
    return predicted.join(inputs, ["user_id", "start_pos"]).groupBy("user_id", "label", "step", "input").agg(
        F.count("y_pred").alias("n"),
        r6(F.sqrt(F.avg(F.col("x") ** 2))).alias("norm"),
        F.abs(r6(F.avg(residual))).alias("mean_residual"),
        F.abs(r6(F.avg(residual * F.col("x")) / size)).alias("explained"),
    )


SINGLE = WindowSettings(("value",), ("value",), input_width=1, label_width=1, shift=1)
SWEEP = f"""WITH pair AS (
  SELECT user_id, value AS x, lead(value) {OVER} AS y, row_number() {OVER} - 1 AS pos, count(*) OVER (PARTITION BY user_id) - 1 AS n FROM events),
cut AS (SELECT * FROM pair WHERE pos < n),
known AS (SELECT user_id, avg(x) AS mx, avg(y) AS my, var_pop(x) AS vx, covar_pop(x, y) AS c FROM cut WHERE pos < 30 GROUP BY user_id),
slope AS (
  SELECT *, 'plain' AS config, c / vx AS w FROM known UNION ALL SELECT *, 'ridge', c / (vx * 1.5) FROM known
  UNION ALL SELECT *, 'lasso', sign(c) * greatest(abs(c) / sqrt(vx) - 0.1, 0) / sqrt(vx) FROM known),
judged AS (SELECT user_id, config, my + w * (x - mx) - y AS gap FROM cut JOIN slope USING (user_id) WHERE pos >= 32),
scored AS (SELECT user_id, config, count(*) AS n, avg(abs(gap)) AS mae, sqrt(avg(gap * gap)) AS rmse FROM judged GROUP BY user_id, config)
SELECT user_id, config, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse,
       row_number() OVER (PARTITION BY user_id ORDER BY round(rmse, 9), config) = 1 AS best FROM scored"""


@query("sweep_by_entity", SWEEP)
def _(spark, sf_dir):
    """Three penalties per user, learned on their first thirty windows and judged on those behind."""
    windows = materialize(_windows(spark, sf_dir, SINGLE))
    train, validation = windows.where("start_pos < 30"), windows.where("start_pos >= 32")
    configs = [SweepConfig("plain"), SweepConfig("ridge", 0.5), SweepConfig("lasso", 0.1, 1.0)]
    found = sweep_by_entity(train, validation, SINGLE, "user_id", configs)
    return found.withColumns({"mae": r6(F.col("mae")), "rmse": r6(F.col("rmse"))})
