"""Streams over the events table: buckets without gaps, and rows without copies."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.session import shared_folder
from millrace.streaming.series import dedup_stream, gap_filled_stream, run_to_table
from queries.registry import query, r6, table


def _stream(spark, sf_dir):
    """The events as a stream of files, their times as TIMESTAMP."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(spark, stream):
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    return run_to_table(stream, f"{folder}/out", f"{folder}/state")


@query(
    "gapfill_stream",
    """WITH closed AS (SELECT max(ts) - INTERVAL '2 hours' AS mark FROM events),
       grid AS (SELECT time_bucket(INTERVAL '15 minutes', ts) AS ts, avg(value) AS value, count(user_id) AS user_id FROM events GROUP BY 1),
       spine AS (SELECT unnest(generate_series((SELECT min(ts) FROM grid), (SELECT max(ts) FROM grid), INTERVAL '15 minutes')) AS ts)
       SELECT spine.ts, round(value, 6) AS value, coalesce(user_id, 0)::BIGINT AS users FROM spine LEFT JOIN grid ON spine.ts = grid.ts
       WHERE spine.ts + INTERVAL '15 minutes' <= (SELECT date_trunc('milliseconds', mark) FROM closed)""",
)
def _(spark, sf_dir):
    filled = gap_filled_stream(_stream(spark, sf_dir), "ts", "15min", {"value": "mean", "user_id": "count"}, "2 hours")
    found = _run(spark, filled)
    return found.select(F.col("ts").cast("timestamp_ntz").alias("ts"), r6(F.col("value")).alias("value"), F.col("user_id").alias("users"))


@query(
    "dedup_stream",
    "SELECT user_id, event_type, ts::DATE AS day, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, ts::DATE AS ts FROM events) GROUP BY ALL",
)
def _(spark, sf_dir):
    """One row per user, kind and day; the horizon spans the table."""
    stream = _stream(spark, sf_dir).withColumn("day", F.to_date("ts"))
    found = _run(spark, dedup_stream(stream, "ts", "60 days", ["user_id", "event_type", "day"]))
    return found.groupBy("user_id", "event_type", "day").agg(F.count(F.lit(1)).alias("n"))
