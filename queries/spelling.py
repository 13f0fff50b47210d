"""Spelling search over a vocabulary of customer codes with planted errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.spelling import CorrectSpelling, SpellingSettings, typos_large
from queries.registry import query, r6, table

SPELT = """
coded AS (SELECT o_orderkey, substr(md5(o_custkey::VARCHAR), 1, CASE WHEN o_custkey % 5 = 0 THEN 32 WHEN o_custkey % 3 = 0 THEN 7 ELSE 10 END) AS right_code FROM orders),
placed AS (SELECT *, (o_orderkey % length(right_code))::INT AS p FROM coded),
spelt AS (
  SELECT o_orderkey, right_code,
         CASE WHEN o_orderkey % 17 = 0 THEN substr(right_code, 1, p) || substr(right_code, p + 2)
              WHEN o_orderkey % 19 = 0 THEN substr(right_code, 1, p) || 'z' || substr(right_code, p + 2)
              WHEN o_orderkey % 23 = 0 THEN substr(right_code, 1, p) || 'y' || substr(right_code, p + 1)
              WHEN o_orderkey % 29 = 0 THEN upper(right_code)
              WHEN o_orderkey % 31 = 0 THEN 'xx' || substr(right_code, 3, length(right_code) - 5) || 'xxx' ELSE right_code END AS code
  FROM placed)"""


def _codes(spark, sf_dir):
    key, code, p = F.col("o_orderkey"), F.col("right_code"), F.col("p")
    length = F.expr("CASE WHEN o_custkey % 5 = 0 THEN 32 WHEN o_custkey % 3 = 0 THEN 7 ELSE 10 END")
    coded = table(spark, sf_dir, "orders").select("o_orderkey", F.substring(F.md5(F.col("o_custkey").cast("string")), F.lit(1), length).alias("right_code"))
    placed = coded.withColumn("p", (key % F.length(code)).cast("int"))
    head, whole = F.substring(code, F.lit(1), p), F.length(code)
    spelt = (
        F.when(key % 17 == 0, F.concat(head, F.substring(code, p + 2, whole)))
        .when(key % 19 == 0, F.concat(head, F.lit("z"), F.substring(code, p + 2, whole)))
        .when(key % 23 == 0, F.concat(head, F.lit("y"), F.substring(code, p + 1, whole)))
        .when(key % 29 == 0, F.upper(code))
        .when(key % 31 == 0, F.concat(F.lit("xx"), F.substring(code, F.lit(3), whole - 5), F.lit("xxx")))
        .otherwise(code)
    )
    return placed.select("o_orderkey", spelt.alias("code"))


ERRORS = f"""WITH {SPELT},
counts AS (SELECT code AS v, lower(code) AS x, count(*) AS n, sum(count(*)) OVER () AS total FROM spelt GROUP BY code),
pair AS (
  SELECT w.v AS wrong, c.v AS correct, c.n AS m, w.x AS x, c.x AS y FROM counts w JOIN counts c
    ON c.n >= 0.0001 * c.total AND c.n > w.n AND w.v <> c.v AND abs(length(w.x) - length(c.x)) <= 0.2 * greatest(length(w.x), length(c.x)) + 1e-9),
scored AS (
  SELECT wrong, correct, m, CASE WHEN x = y THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - levenshtein(x, y) / greatest(length(x), length(y))::DOUBLE END AS similarity FROM pair),
typos AS (SELECT * FROM scored WHERE similarity >= 0.8 QUALIFY row_number() OVER (PARTITION BY wrong ORDER BY similarity DESC, m DESC, correct) = 1)"""

SETTINGS = SpellingSettings(("code",))


@query("typos_large", f"""{ERRORS} SELECT 'code' AS "column", wrong, correct, round(similarity, 6) AS similarity FROM typos""")
def _(spark, sf_dir):
    return typos_large(_codes(spark, sf_dir), SETTINGS).withColumn("similarity", r6(F.col("similarity")))


@query("correct_spelling", f"""{ERRORS} SELECT o_orderkey, coalesce(correct, code) AS code FROM spelt LEFT JOIN typos ON code = wrong""")
def _(spark, sf_dir):
    return CorrectSpelling(SETTINGS).fit_transform(_codes(spark, sf_dir))
