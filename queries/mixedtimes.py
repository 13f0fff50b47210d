"""Event times written in nine ways, read back from one text column."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.mixedtimes import ParseMixedTimes, MixedTimeSettings, parse_time_mixed, time_shapes
from queries.registry import query, table

# Pattern of each way, and what it keeps of a moment.
WAYS = (
    ("yyyy-MM-dd HH:mm:ss", "second"), ("dd/MM/yyyy HH:mm:ss", "second"), ("dd.MM.yyyy", "day"), ("yyyy/MM/dd HH:mm", "minute"),
    ("d MMM yyyy HH:mm", "minute"), ("MMMM d, yyyy h:mm a", "minute"), ("yyyyMMdd'T'HHmmss", "second"), ("yyyy-MM-dd'T'HH:mm:ss'Z'", "second"),
)


def _written(spark, sf_dir):
    """One way per event by its id; every ninth as seconds since 1970, every fiftieth no time at all."""
    key, text = F.col("event_id"), F.when(F.col("event_id") % 50 == 49, F.lit("soon, perhaps"))
    for i, (pattern, _) in enumerate(WAYS):
        text = text.when(key % 9 == i, F.date_format("ts", pattern))
    return table(spark, sf_dir, "events").select("event_id", text.otherwise(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")).alias("written"))


KEPT = "CASE WHEN event_id % 50 = 49 THEN NULL " + " ".join(f"WHEN event_id % 9 = {i} THEN date_trunc('{kept}', ts)" for i, (_, kept) in enumerate(WAYS)) + " ELSE date_trunc('second', ts) END"


@query("parse_time_mixed", f"SELECT event_id, ({KEPT})::TIMESTAMP AS written FROM events")
def _(spark, sf_dir):
    return parse_time_mixed(_written(spark, sf_dir), "written")


@query("parse_mixed_step", f"SELECT event_id, ({KEPT})::TIMESTAMP AS written FROM events")
def _(spark, sf_dir):
    """Learned on the first half of the month, where days up to 15 tell day from month, applied to all."""
    written = _written(spark, sf_dir)
    half = written.join(table(spark, sf_dir, "events").where("ts < timestamp_ntz'2024-01-16 00:00:00'").select("event_id"), "event_id")
    return ParseMixedTimes(MixedTimeSettings(("written",))).fit(half).transform(written)


@query(
    "time_shapes",
    """SELECT family, count(*) AS n, count(*) FILTER (family IS NOT NULL) AS n_parsed FROM (
         SELECT CASE WHEN event_id % 50 = 49 THEN NULL WHEN event_id % 9 IN (0, 3, 7) THEN 'year_first' WHEN event_id % 9 IN (1, 2) THEN 'year_last'
                     WHEN event_id % 9 = 4 THEN 'day_name_year' WHEN event_id % 9 = 5 THEN 'name_day_year' WHEN event_id % 9 = 6 THEN 'compact'
                     ELSE 'epoch' END AS family FROM events) GROUP BY family""",
)
def _(spark, sf_dir):
    shapes = time_shapes(_written(spark, sf_dir), "written")
    return shapes.groupBy("family").agg(F.sum("n").alias("n"), F.sum("n_parsed").alias("n_parsed"))
