"""Other series beside the events: the user's latest error, promotions that hold an event, and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.attach import asof_attach, interval_attach
from millrace.operators.sessions import sessionize, with_sessions
from queries.registry import query, r6, table


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


@query(
    "asof_attach",
    """WITH err AS (SELECT user_id, ts, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events WHERE event_type = 'error' GROUP BY user_id, ts)
       SELECT e.event_id, r.event_id AS error_event_id, round(r.value, 6) AS error_value FROM events e ASOF LEFT JOIN err r ON e.user_id = r.user_id AND e.ts >= r.ts""",
)
def _(spark, sf_dir):
    events = _events(spark, sf_dir)
    errors = events.where("event_type = 'error'")
    found = asof_attach(events, errors, "ts", ["event_id", "value"], ["user_id"], tie="event_id", prefix="error_")
    return found.select("event_id", "error_event_id", r6(F.col("error_value")).alias("error_value"))


@query(
    "asof_within",
    """WITH err AS (SELECT ts, arg_max(value, event_id) AS value FROM events WHERE event_type = 'error' GROUP BY ts)
       SELECT e.event_id, CASE WHEN e.ts - r.ts <= INTERVAL '10 minutes' THEN round(r.value, 6) END AS value
       FROM (SELECT * FROM events WHERE event_type <> 'error') e ASOF LEFT JOIN err r ON e.ts > r.ts""",
)
def _(spark, sf_dir):
    """The latest error of anyone, strictly before and at most ten minutes old."""
    events = _events(spark, sf_dir)
    others, errors = events.where("event_type <> 'error'"), events.where("event_type = 'error'")
    found = asof_attach(others.select("event_id", "ts"), errors, "ts", ["value"], tie="event_id", tolerance_seconds=600, exact=False)
    return found.select("event_id", r6(F.col("value")).alias("value"))


PROMOTIONS = """promotion AS (
  SELECT event_id AS promotion_id, user_id, CASE WHEN event_id % 10 <> 0 THEN ts END AS from_ts,
         CASE WHEN event_id % 7 <> 0 THEN ts + to_minutes((event_id * event_id % 5000)::INT) END AS to_ts
  FROM events WHERE event_type = 'signup')"""


def _promotions(spark, sf_dir):
    signed = _events(spark, sf_dir).where("event_type = 'signup'")
    minutes = F.make_dt_interval(mins=(F.col("event_id") * F.col("event_id") % 5000).cast("int"))
    return signed.select(
        F.col("event_id").alias("promotion_id"), "user_id", F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("from_ts"),
        F.when(F.col("event_id") % 7 != 0, F.col("ts") + minutes).alias("to_ts"))


@query(
    "interval_attach",
    f"""WITH {PROMOTIONS} SELECT event_id, promotion_id FROM events e JOIN promotion p
        ON e.user_id = p.user_id AND (from_ts IS NULL OR from_ts <= ts) AND (to_ts IS NULL OR ts < to_ts)""",
)
def _(spark, sf_dir):
    found = interval_attach(_events(spark, sf_dir), _promotions(spark, sf_dir), "ts", "from_ts", "to_ts", ["promotion_id"], ["user_id"])
    return found.select("event_id", "promotion_id")


@query(
    "interval_attach_left",
    f"""WITH {PROMOTIONS} SELECT event_id, promotion_id FROM events e LEFT JOIN (SELECT * FROM promotion WHERE to_ts - from_ts < INTERVAL '1 hour') p
        ON e.user_id = p.user_id AND from_ts <= ts AND ts < to_ts""",
)
def _(spark, sf_dir):
    short = _promotions(spark, sf_dir).where("to_ts - from_ts < interval '1' hour")
    found = interval_attach(_events(spark, sf_dir), short, "ts", "from_ts", "to_ts", ["promotion_id"], ["user_id"], how="left")
    return found.select("event_id", "promotion_id")


SESSIONS = """stepped AS (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
numbered AS (
  SELECT *, (sum(CASE WHEN before IS NULL OR ts - before > INTERVAL '6 hours' THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - 1)::BIGINT AS session FROM stepped)"""


@query(
    "sessionize",
    f"""WITH {SESSIONS} SELECT user_id, session, min(ts) AS start, max(ts) AS "end", count(*) AS n,
          (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS seconds, round(avg(value), 6) AS value, count(DISTINCT event_type) AS kinds
        FROM numbered GROUP BY user_id, session""",
)
def _(spark, sf_dir):
    found = sessionize(_events(spark, sf_dir), "user_id", "ts", "event_id", 6 * 3600, {"value": "mean"}, {"kinds": F.count_distinct("event_type")})
    return found.withColumn("value", r6(F.col("value")))


@query("with_sessions", f"WITH {SESSIONS} SELECT event_id, user_id, session FROM numbered")
def _(spark, sf_dir):
    return with_sessions(_events(spark, sf_dir), "user_id", "ts", "event_id", 6 * 3600).select("event_id", "user_id", "session")
