"""Metrics of naive predictions over all combinations of market, status and split, with every subtotal."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.cubes import metrics_cube
from queries.registry import query, r6, table

BY = ["event_type", "split", "hour"]
JUDGED = """judged AS (
  SELECT CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type, CASE WHEN event_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         (hour(ts) // 6)::INT AS hour, CASE WHEN event_id % 13 <> 0 THEN value END AS y, user_id::DOUBLE AS guess, (value > 20)::INT AS hit,
         (event_id * 37 % 101) / 101.0::DOUBLE AS p, event_id % 3 AS code FROM events)"""


def _judged(spark, sf_dir):
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.when(key % 7 != 0, F.col("event_type")).alias("event_type"), F.when(key % 5 == 0, "test").otherwise("train").alias("split"),
        F.floor(F.hour("ts") / 6).cast("int").alias("hour"), F.when(key % 13 != 0, F.col("value")).alias("y"),
        F.col("user_id").cast("double").alias("guess"), (F.col("value") > 20).cast("int").alias("hit"), (key * 37 % 101 / 101).alias("p"), (key % 3).alias("code"))


@query(
    "metrics_cube",
    f"""WITH {JUDGED} SELECT event_type, split, hour, grouping(event_type, split, hour)::INT AS grouping, count(y) AS n, round(avg(abs(guess - y)), 6) AS mae,
          round(avg((guess - y) ** 2), 6) AS mse, round(sqrt(avg((guess - y) ** 2)), 6) AS rmse, min(guess) AS pred_min, max(guess) AS pred_max,
          round(min(y), 6) AS true_min, round(max(y), 6) AS true_max
        FROM judged GROUP BY CUBE (event_type, split, hour)""",
)
def _(spark, sf_dir):
    found = metrics_cube(_judged(spark, sf_dir), "y", "guess", BY)
    return found.withColumns({c: r6(F.col(c)) for c in ("mae", "mse", "rmse", "true_min", "true_max")})


COUNTS = """count(*) AS n, count(*) FILTER (hit = 1 AND p > 0.5) AS tp, count(*) FILTER (hit = 0 AND p > 0.5) AS fp,
          count(*) FILTER (hit = 1 AND p <= 0.5) AS fn, count(*) FILTER (hit = 0 AND p <= 0.5) AS tn,
          avg(-ln(greatest(1e-7, CASE WHEN hit = 1 THEN p ELSE 1 - p END))) AS loss"""


@query(
    "metrics_sets",
    f"""WITH {JUDGED}, counted AS (
          SELECT event_type, split, hour, grouping(event_type, split, hour)::INT AS grouping, {COUNTS}
          FROM judged GROUP BY GROUPING SETS ((event_type, split), (hour), ()))
        SELECT event_type, split, hour, grouping, n, tp, fp, fn, tn, round((tp + tn) / n, 6) AS accuracy,
               round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
               round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(loss, 6) AS log_loss FROM counted""",
)
def _(spark, sf_dir):
    found = metrics_cube(_judged(spark, sf_dir), "hit", "p", BY, "binary", [["event_type", "split"], ["hour"], []])
    return found.withColumns({c: r6(F.col(c)) for c in ("accuracy", "precision", "recall", "f1", "log_loss")})


@query(
    "confusion_cube",
    f"""WITH {JUDGED} SELECT split, hit AS y_true, code AS y_pred, grouping(split, hit, code)::INT AS grouping, count(*) AS n
        FROM judged GROUP BY CUBE (split, hit, code)""",
)
def _(spark, sf_dir):
    return metrics_cube(_judged(spark, sf_dir), "hit", "code", ["split"], "confusion")
