"""Category cleaning and encoding, and missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.categories import (
    Categories, CategorySettings, Encode, EncodeSettings, boolean_tokens, category_report,
    category_typos, embedding_profile, null_tokens, similarity,
)
from millrace.operators.missing import FillMissing, FillSettings
from queries.registry import (
    DIRTY, DIRTY_ORDERS, dirty_events, dirty_orders, query, r6, table,
)

SIMILARITY = """(CASE WHEN lower({a}) = lower({b}) THEN 1.0::DOUBLE ELSE 1.0::DOUBLE -
  levenshtein(lower({a}), lower({b})) / greatest(length({a}), length({b}))::DOUBLE END)"""


@query(
    "null_tokens",
    f"""WITH {DIRTY_ORDERS} SELECT o_orderkey, CASE WHEN o_orderkey % 23 <> 0 AND o_orderkey % 29 <> 0
          THEN priority END AS priority FROM spelt""",
)
def _(spark, sf_dir):
    return null_tokens(dirty_orders(spark, sf_dir), ["priority"]).select("o_orderkey", "priority")


@query(
    "boolean_tokens",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'true'
              ELSE o_orderpriority END AS answer FROM orders""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey") % 4
    answer = F.when(key == 0, "Yes").when(key == 1, " n ").when(key == 2, "TRUE")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", answer.otherwise(F.col("o_orderpriority")).alias("answer")
    )
    return boolean_tokens(orders, ["answer"])


@query(
    "category_similarity",
    f"""WITH {DIRTY_ORDERS} SELECT o_orderkey,
          round({SIMILARITY.format(a="priority", b="o_orderpriority")}, 6) AS similarity FROM spelt""",
)
def _(spark, sf_dir):
    score = similarity(F.col("priority"), F.col("o_orderpriority"))
    return dirty_orders(spark, sf_dir).select("o_orderkey", r6(score).alias("similarity"))


TYPOS = f"""WITH {DIRTY_ORDERS},
counts AS (SELECT priority AS v, count(*) AS n, sum(count(*)) OVER () AS total FROM spelt GROUP BY 1),
pairs AS (
  SELECT a.v AS wrong, b.v AS correct, {SIMILARITY.format(a="a.v", b="b.v")} AS similarity,
         row_number() OVER (PARTITION BY a.v ORDER BY {SIMILARITY.format(a="a.v", b="b.v")} DESC, b.n DESC, b.v) AS rn
  FROM counts a JOIN counts b ON b.n > a.n AND b.v <> a.v AND b.n >= 0.01 * b.total
  WHERE {SIMILARITY.format(a="a.v", b="b.v")} >= 0.8),
typos AS (SELECT wrong, correct, similarity FROM pairs WHERE rn = 1)"""


@query(
    "category_typos",
    f"""{TYPOS} SELECT 'priority' AS "column", wrong, correct, round(similarity, 6) AS similarity FROM typos""",
)
def _(spark, sf_dir):
    found = category_typos(dirty_orders(spark, sf_dir), CategorySettings(("priority",)))
    return found.withColumn("similarity", r6(F.col("similarity")))


@query(
    "correct_typos",
    f"""{TYPOS} SELECT o_orderkey, CASE WHEN n >= 0.01 * total THEN priority
                    ELSE coalesce(correct, 'Other') END AS priority
        FROM spelt JOIN counts ON priority = v LEFT JOIN typos ON priority = wrong""",
)
def _(spark, sf_dir):
    orders = dirty_orders(spark, sf_dir).select("o_orderkey", "priority")
    return Categories(CategorySettings(("priority",))).fit_transform(orders)


@query(
    "rare_categories",
    f"""{TYPOS} SELECT o_orderkey, CASE WHEN n >= 0.04 * total THEN priority ELSE 'Other' END AS priority
        FROM spelt JOIN counts ON priority = v""",
)
def _(spark, sf_dir):
    orders = dirty_orders(spark, sf_dir).select("o_orderkey", "priority")
    settings = CategorySettings(("priority",), rare_threshold=0.04, auto_correct_typos=False)
    return Categories(settings).fit_transform(orders)


@query(
    "category_report",
    f"""{TYPOS} SELECT 'priority' AS "column", count(*) AS categories,
          count(*) FILTER (n < 0.01 * total) AS rare, (SELECT count(*) FROM typos) AS typos,
          (SELECT v FROM counts ORDER BY n DESC, v LIMIT 1) AS top_value,
          round(max(n / total), 6) AS top_share FROM counts""",
)
def _(spark, sf_dir):
    report = category_report(dirty_orders(spark, sf_dir), CategorySettings(("priority",)))
    return report.withColumn("top_share", r6(F.col("top_share")))


ENCODED = f"""WITH {DIRTY_ORDERS}, codes AS (
  SELECT o_orderpriority AS v, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code
  FROM (SELECT DISTINCT o_orderpriority FROM orders)),
encoded AS (
  SELECT o_orderkey, coalesce(code, (SELECT count(*) FROM codes)) AS priority
  FROM spelt LEFT JOIN codes ON priority = v)"""


def _encoder(spark, sf_dir, **options):
    clean = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"))
    return Encode(EncodeSettings(("priority",), **options)).fit(clean)


@query("encode_categories", f"{ENCODED} SELECT o_orderkey, priority FROM encoded")
def _(spark, sf_dir):
    orders = dirty_orders(spark, sf_dir).select("o_orderkey", "priority")
    return _encoder(spark, sf_dir).transform(orders)


@query(
    "decode_categories",
    f"""{ENCODED} SELECT o_orderkey, coalesce(v, '__UNKNOWN__') AS priority
        FROM encoded LEFT JOIN codes ON code = priority""",
)
def _(spark, sf_dir):
    orders = dirty_orders(spark, sf_dir).select("o_orderkey", "priority")
    encoder = _encoder(spark, sf_dir)
    return encoder.decode(encoder.transform(orders))


@query(
    "encode_many_categories",
    """WITH codes AS (SELECT c_name AS v, dense_rank() OVER (ORDER BY c_name) - 1 AS code
                      FROM (SELECT DISTINCT c_name FROM customer))
       SELECT o_orderkey, coalesce(code, (SELECT count(*) FROM codes)) AS name
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Customer#000000001'
                    WHEN o_orderkey % 50 = 0 THEN 'nobody' ELSE c_name END AS name
             FROM orders LEFT JOIN customer ON o_custkey = c_custkey) LEFT JOIN codes ON name = v""",
)
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    encoder = Encode(EncodeSettings(("name",), driver_limit=100)).fit(
        customers.select(F.col("c_name").alias("name"))
    )
    key = F.col("o_orderkey")
    name = F.when(key % 3 == 0, "Customer#000000001").when(key % 50 == 0, "nobody")
    orders = table(spark, sf_dir, "orders").join(customers, F.expr("o_custkey = c_custkey"), "left")
    return encoder.transform(orders.select("o_orderkey", name.otherwise(F.col("c_name")).alias("name")))


def _embedding_sql(columns: dict[str, str]) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(DISTINCT {c}) AS k, count({c}) AS n FROM {t}"
        for c, t in columns.items()
    )
    return f"""SELECT col AS "column", k AS categories, round(k / n, 6) AS unique_ratio,
        k >= 2 AND k / n < 0.5 AS use_embedding,
        CAST(CASE WHEN k >= 2 AND k / n < 0.5 THEN
               CASE WHEN k <= 2 THEN 1 WHEN k <= 5 THEN 3 WHEN k <= 10 THEN 4 WHEN k <= 20 THEN 6
                    WHEN k <= 50 THEN 8 ELSE least(50, floor(1.6 * pow(k, 0.56))) END
             ELSE greatest(1, least(2, k // 20)) END AS INT) AS width FROM ({counts})"""


CUSTOMER_TEXT = ["c_name", "c_mktsegment", "nation"]


@query(
    "embedding_profile",
    _embedding_sql({c: "(SELECT *, c_nationkey::VARCHAR AS nation FROM customer)" for c in CUSTOMER_TEXT}),
)
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    customers = customers.withColumn("nation", F.col("c_nationkey").cast("string"))
    profile = embedding_profile(customers, CUSTOMER_TEXT)
    return profile.withColumn("unique_ratio", r6(F.col("unique_ratio")))


def _filled(spark, sf_dir, columns: list[str], **settings):
    events = dirty_events(spark, sf_dir).select("event_id", "ts", *columns)
    filled = FillMissing(FillSettings(row_id="event_id", time="ts", **settings)).fit_transform(events)
    values = {"value": r6(F.col("value"))} if "value" in columns else {}
    return filled.withColumns(values).drop("ts")


@query(
    "fill_constant",
    f"WITH {DIRTY} SELECT event_id, coalesce(round(value, 6), -1) AS value FROM dirty",
)
def _(spark, sf_dir):
    return _filled(spark, sf_dir, ["value"], rules={"value": "constant"}, constants={"value": -1.0})


@query(
    "fill_mean",
    f"""WITH {DIRTY} SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM dirty)), 6) AS value
        FROM dirty""",
)
def _(spark, sf_dir):
    return _filled(spark, sf_dir, ["value"], rules={"value": "mean"})


@query(
    "fill_median",
    f"""WITH {DIRTY} SELECT event_id, round(coalesce(value, (SELECT median(value) FROM dirty)), 6) AS value
        FROM dirty""",
)
def _(spark, sf_dir):
    return _filled(spark, sf_dir, ["value"], rules={"value": "median"})


MODES = """(SELECT event_type FROM dirty WHERE event_type IS NOT NULL GROUP BY 1
            ORDER BY count(*) DESC, 1 LIMIT 1)"""


@query(
    "fill_mode",
    f"""WITH {DIRTY} SELECT event_id, coalesce(event_type, {MODES}) AS event_type,
          coalesce(user_id, (SELECT user_id FROM dirty WHERE user_id IS NOT NULL GROUP BY 1
                             ORDER BY count(*) DESC, 1 LIMIT 1)) AS user_id
        FROM dirty""",
)
def _(spark, sf_dir):
    rules = {"user_id": "mode", "event_type": "mode"}
    return _filled(spark, sf_dir, ["user_id", "event_type"], rules=rules)


def _carry_sql(function: str, frame: str) -> str:
    over = f"OVER (ORDER BY ts, event_id ROWS BETWEEN {frame})"
    return f"""WITH {DIRTY} SELECT event_id, round({function}(value IGNORE NULLS) {over}, 6) AS value,
          {function}(event_type IGNORE NULLS) {over} AS event_type FROM dirty"""


@query("fill_forward", _carry_sql("last_value", "UNBOUNDED PRECEDING AND CURRENT ROW"))
def _(spark, sf_dir):
    rules = {"value": "ffill", "event_type": "ffill"}
    return _filled(spark, sf_dir, ["value", "event_type"], rules=rules)


@query("fill_backward", _carry_sql("first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING"))
def _(spark, sf_dir):
    rules = {"value": "bfill", "event_type": "bfill"}
    return _filled(spark, sf_dir, ["value", "event_type"], rules=rules)


@query(
    "fill_skip",
    f"""WITH {DIRTY} SELECT event_id, round(value, 6) AS value, event_type,
          coalesce(user_id::DOUBLE, (SELECT avg(user_id) FROM dirty)) AS user_id FROM dirty""",
)
def _(spark, sf_dir):
    return _filled(
        spark, sf_dir, ["value", "user_id", "event_type"], rules={"user_id": "mean"}, skip=("value",)
    )


SKEWED = """(SELECT abs(avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5)) > 1
  FROM (SELECT {c}, avg({c}) OVER () AS m FROM dirty WHERE {c} IS NOT NULL))"""


@query(
    "fill_smart",
    f"""WITH {DIRTY} SELECT event_id,
          round(coalesce(value, CASE WHEN {SKEWED.format(c="value")} THEN (SELECT median(value) FROM dirty)
                          ELSE (SELECT avg(value) FROM dirty) END), 6) AS value,
          round(coalesce(user_id::DOUBLE, CASE WHEN {SKEWED.format(c="user_id")}
                          THEN (SELECT median(user_id) FROM dirty)
                          ELSE (SELECT avg(user_id) FROM dirty) END), 6) AS user_id,
          coalesce(event_type, {MODES}) AS event_type FROM dirty""",
)
def _(spark, sf_dir):
    filled = _filled(spark, sf_dir, ["value", "user_id", "event_type"], smart=True)
    return filled.withColumn("user_id", r6(F.col("user_id")))


@query(
    "missing_indicator",
    f"""WITH {DIRTY} SELECT event_id, value IS NULL AND true AS gap,
          CAST(value IS NULL AS TINYINT) AS value_missing_indicator FROM dirty""",
)
def _(spark, sf_dir):
    events = dirty_events(spark, sf_dir).select("event_id", "value", F.col("value").isNull().alias("gap"))
    settings = FillSettings({"value": "mean"}, important=("value", "event_id"))
    return FillMissing(settings).fit_transform(events).drop("value")


@query(
    "fill_all",
    f"""WITH {DIRTY} SELECT event_id, round(coalesce(value, (SELECT median(value) FROM dirty)), 6) AS value,
          coalesce(user_id, 0) AS user_id, coalesce(event_type, 'none') AS event_type FROM dirty""",
)
def _(spark, sf_dir):
    return _filled(
        spark,
        sf_dir,
        ["value", "user_id", "event_type"],
        rules={"value": "median", "user_id": "constant", "event_type": "constant"},
        constants={"user_id": 0, "event_type": "none"},
    )
