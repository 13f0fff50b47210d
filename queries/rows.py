"""De-duplication, sampling, resampling, splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_rows, duplicate_rows
from millrace.operators.sampling import SystematicSample, TimeResample
from millrace.operators.splitting import Ratios, ShuffledSplit, TimeSplit
from queries.registry import query, r6, table

RANKED = """SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS rn FROM documents"""


@query(
    "dedup_rows",
    f"""SELECT doc_id, lang, source, n_chars, md5(text) AS digest FROM ({RANKED}) WHERE rn = 1""",
)
def _(spark, sf_dir):
    kept = dedup_rows(table(spark, sf_dir, "documents"), "doc_id", ["text", "lang"])
    return kept.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("digest"))


@query(
    "duplicate_rows",
    """SELECT event_id, user_id, event_type, day FROM (
         SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day, row_number() OVER (
                PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS rn
         FROM events) WHERE rn > 1""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day")
    )
    return duplicate_rows(events, "event_id")


POSITIONS = "row_number() OVER (ORDER BY ts, event_id) - 1"


@query(
    "systematic_sample",
    f"""SELECT event_id, ts, value, CAST((p - 5) / 6 AS BIGINT) AS pos
        FROM (SELECT event_id, ts, value, {POSITIONS} AS p FROM events)
        WHERE p >= 5 AND (p - 5) % 6 = 0""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return SystematicSample(5, 6, reset_index=True).apply(events, "ts", "event_id")


@query(
    "resample_time",
    """SELECT time_bucket(INTERVAL '6 hours', ts) AS ts, round(avg(value), 6) AS value,
              CAST(sum(user_id) AS BIGINT) AS user_id FROM events GROUP BY 1""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "value", "user_id")
    grid = TimeResample("ts", "6H", "mean", label="user_id", label_aggregation="sum").apply(events)
    return grid.withColumn("value", r6(F.col("value")))


@query(
    "resample_time_gapfill",
    """WITH e AS (SELECT time_bucket(INTERVAL '2 minutes', ts) AS ts, avg(value) AS value,
                         sum(user_id) AS user_id FROM events GROUP BY 1),
            s AS (SELECT unnest(generate_series((SELECT min(ts) FROM e), (SELECT max(ts) FROM e),
                                                INTERVAL '2 minutes')) AS ts)
       SELECT s.ts, round(e.value, 6) AS value, CAST(coalesce(e.user_id, 0) AS BIGINT) AS user_id
       FROM s LEFT JOIN e ON s.ts = e.ts""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", "value", "user_id")
    plan = {"value": "mean", "user_id": "sum"}
    grid = TimeResample("ts", "2min", plan, keep_empty=True).apply(events)
    return grid.withColumn("value", r6(F.col("value")))


@query(
    "split_time_ordered",
    f"""SELECT event_id, CASE WHEN p < floor(n * 0.6 + 0.5) THEN 'train'
               WHEN p < floor(n * 0.6 + 0.5) + floor(n * 0.3 + 0.5) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT event_id, {POSITIONS} AS p, count(*) OVER () AS n FROM events)""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return TimeSplit(Ratios(0.6, 0.3, 0.1)).apply(events, "ts", "event_id").drop("ts")


@query(
    "split_shuffled",
    """SELECT event_id, CASE WHEN p < floor(n * 0.7 + 0.5) THEN 'train'
              WHEN p < floor(n * 0.7 + 0.5) + floor(n * 0.2 + 0.5) THEN 'val' ELSE 'test' END AS split
       FROM (SELECT event_id, count(*) OVER () AS n, row_number() OVER (
                    ORDER BY substr(md5(event_id || ':42'), 1, 15), event_id) - 1 AS p FROM events)""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id")
    return ShuffledSplit(Ratios(0.7, 0.2, 0.1), seed=42).apply(events, "event_id")
