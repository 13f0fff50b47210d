"""JSON texts of events: the given ones, and richer ones made from all columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.nested import JsonColumns, JsonSettings, json_profile
from queries.registry import query, r6, table


def _rich(spark, sf_dir):
    """The event as a nested document; kinds of values and presence of members depend on its id."""
    key = F.col("event_id")
    amount = F.when(key % 4 == 0, F.format_string('"%s"', F.col("event_type"))).when(key % 4 == 1, F.col("user_id").cast("string")).otherwise(
        F.format_string("%.2f", F.col("value")))
    member = F.when(key % 3 == 0, F.format_string(', "who": {"id": %d, "new tag": %s}', F.col("user_id"), (key % 2 == 0).cast("string"))).otherwise("")
    items = F.when(key % 5 == 0, F.format_string(', "list": [%d, {"x": null}, "t"]', key)).otherwise("")
    text = F.concat(F.lit('{"amount": '), amount, member, items, F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", F.when(key % 50 == 7, F.lit("{broken")).when(key % 50 == 8, None).otherwise(text).alias("doc"))


RICH = "SELECT *, event_id % 50 NOT IN (7, 8) AS whole FROM events"
KINDS = (
    ("$", "object", "whole"), ("$", "invalid", "event_id % 50 = 7"), ("$.amount", "string", "whole AND event_id % 4 = 0"),
    ("$.amount", "bigint", "whole AND event_id % 4 = 1"), ("$.amount", "decimal", "whole AND event_id % 4 > 1"),
    ("$.who", "object", "whole AND event_id % 3 = 0"), ("$.who.id", "bigint", "whole AND event_id % 3 = 0"),
    ("$.who['new tag']", "boolean", "whole AND event_id % 3 = 0"), ("$.list", "array", "whole AND event_id % 5 = 0"),
    ("$.list[*]", "bigint", "whole AND event_id % 5 = 0"), ("$.list[*]", "object", "whole AND event_id % 5 = 0"),
    ("$.list[*]", "string", "whole AND event_id % 5 = 0"), ("$.list[*].x", "null", "whole AND event_id % 5 = 0"),
)
COUNTED = " UNION ALL ".join(
    "SELECT '{}' AS path, '{}' AS type, count(*) AS n FROM rich WHERE {}".format(p.replace("'", "''"), t, c) for p, t, c in KINDS)


@query(
    "json_profile",
    f"""WITH rich AS ({RICH}), counted AS ({COUNTED})
        SELECT path, type, n, round(n / sum(n) OVER (PARTITION BY path), 6) AS share FROM counted WHERE n > 0""",
)
def _(spark, sf_dir):
    return json_profile(_rich(spark, sf_dir), "doc").withColumn("share", r6(F.col("share")))


@query(
    "json_columns",
    f"""SELECT event_id, CASE WHEN whole THEN CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN user_id::VARCHAR ELSE NULL END END AS doc_amount,
          CASE WHEN whole AND event_id % 3 = 0 THEN user_id END AS doc_who_id,
          CASE WHEN whole AND event_id % 3 = 0 THEN event_id % 2 = 0 END AS "doc_who_new tag" FROM ({RICH})""",
)
def _(spark, sf_dir):
    """Numbers with a fraction are compared in ``json_numbers``; here they are left out."""
    docs = _rich(spark, sf_dir)
    found = JsonColumns(JsonSettings(("doc",))).fit_transform(docs)
    return found.select("event_id", F.when(F.col("event_id") % 4 < 2, F.col("doc_amount")).alias("doc_amount"), "doc_who_id", "`doc_who_new tag`")


@query("json_numbers", "SELECT event_id, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS props_k FROM events")
def _(spark, sf_dir):
    return JsonColumns(JsonSettings(("props",), drop=True)).fit_transform(table(spark, sf_dir, "events")).select("event_id", "props_k")
