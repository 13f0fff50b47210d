"""Scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.scaling import Scale, ScaleSettings, scaling_stats
from queries.registry import query, r6, table

LINE = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def _lines(spark, sf_dir, *columns: str):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *columns)


def _rounded(df, *columns: str):
    return df.withColumns({c: r6(F.col(c)) for c in columns})


def _scaled(spark, sf_dir, transformers: list[dict], *columns: str):
    lines = _lines(spark, sf_dir, *columns)
    settings = ScaleSettings.from_dict({"transformers": transformers}, only_listed=True)
    return _rounded(Scale(settings).fit_transform(lines), *columns)


@query(
    "scale_minmax",
    """SELECT l_orderkey, l_linenumber,
              round((l_extendedprice - p0) / (p1 - p0) * 2 - 1, 6) AS l_extendedprice,
              round((l_quantity - q0) / (q1 - q0) * 2 - 1, 6) AS l_quantity
       FROM lineitem, (SELECT min(l_extendedprice) AS p0, max(l_extendedprice) AS p1,
                              min(l_quantity) AS q0, max(l_quantity) AS q1 FROM lineitem)""",
)
def _(spark, sf_dir):
    columns = ["l_extendedprice", "l_quantity"]
    rule = {"minmax": {"columns": columns, "feature_range": (-1, 1)}}
    return _scaled(spark, sf_dir, [rule], *columns)


@query(
    "scale_standard",
    """SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / s, 6) AS l_extendedprice,
              round(l_quantity / qs, 6) AS l_quantity
       FROM lineitem, (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s,
                              stddev_pop(l_quantity) AS qs FROM lineitem)""",
)
def _(spark, sf_dir):
    rules = [
        {"standard": {"columns": ["l_extendedprice"]}},
        {"standard": {"columns": ["l_quantity"], "with_mean": False}},
    ]
    return _scaled(spark, sf_dir, rules, "l_extendedprice", "l_quantity")


@query(
    "scale_robust",
    """SELECT l_orderkey, l_linenumber, round((l_extendedprice - m) / (hi - lo), 6) AS l_extendedprice
       FROM lineitem, (SELECT median(l_extendedprice) AS m, quantile_cont(l_extendedprice, 0.1) AS lo,
                              quantile_cont(l_extendedprice, 0.9) AS hi FROM lineitem)""",
)
def _(spark, sf_dir):
    rule = {"robust": {"columns": ["l_extendedprice"], "quantile_range": (10, 90)}}
    return _scaled(spark, sf_dir, [rule], "l_extendedprice")


MIXED = {
    "transformers": [
        {"standard": {"columns": ["l_extendedprice"]}},
        {"minmax": {"columns": ["l_discount"], "feature_range": (0, 1)}},
        {"robust": {"columns": ["l_quantity"], "quantile_range": (25, 75)}},
    ],
    "skip_scale": ["l_orderkey", "l_linenumber"],
}


def _mixed(spark, sf_dir):
    """Four measures and a flag; ``l_tax`` and the flag are left to the recommendation."""
    flag = F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("is_outlier_q")
    lines = _lines(spark, sf_dir, *LINE).withColumn("is_outlier_q", flag)
    return lines, Scale(ScaleSettings.from_dict(MIXED)).fit(lines)


@query(
    "scale_mixed",
    """SELECT l_orderkey, l_linenumber, round((l_extendedprice - pm) / ps, 6) AS l_extendedprice,
              round((l_discount - d0) / (d1 - d0), 6) AS l_discount,
              round((l_quantity - qm) / (q3 - q1), 6) AS l_quantity,
              round((l_tax - tm) / ts, 6) AS l_tax, CAST(l_quantity > 25 AS INT) AS is_outlier_q
       FROM lineitem, (SELECT avg(l_extendedprice) AS pm, stddev_pop(l_extendedprice) AS ps,
              min(l_discount) AS d0, max(l_discount) AS d1, median(l_quantity) AS qm,
              quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3,
              avg(l_tax) AS tm, stddev_pop(l_tax) AS ts FROM lineitem)""",
)
def _(spark, sf_dir):
    lines, model = _mixed(spark, sf_dir)
    return _rounded(model.transform(lines), *LINE)


@query(
    "unscale",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) AS l_extendedprice,
              round(l_discount, 6) AS l_discount, round(l_quantity, 6) AS l_quantity,
              round(l_tax, 6) AS l_tax FROM lineitem""",
)
def _(spark, sf_dir):
    lines, model = _mixed(spark, sf_dir)
    return _rounded(model.inverse(model.transform(lines)), *LINE).drop("is_outlier_q")


SHAPE = """SELECT '{c}' AS c, abs(avg(pow({c} - m, 3)) / pow(avg(pow({c} - m, 2)), 1.5)) > 1
    OR min({c}) < min(q1) - 1.5 * (min(q3) - min(q1)) OR max({c}) > min(q3) + 1.5 * (min(q3) - min(q1)) AS odd
  FROM {t}, (SELECT avg({c}) AS m, quantile_cont({c}::DOUBLE, 0.25) AS q1,
                    quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {t})"""


@query(
    "recommend_scaler",
    f"""SELECT c AS "column", CASE WHEN odd THEN 'robust' ELSE 'standard' END AS method, true AS scaled
        FROM ({" UNION ALL ".join(SHAPE.format(c=c, t="events") for c in ("value", "user_id"))})
        UNION ALL SELECT 'constant', 'cons_skip', false UNION ALL SELECT 'empty', 'standard_skip', false
        UNION ALL SELECT 'flag', 'flag_skip', false UNION ALL SELECT 'event_id', 'user_skip', false
        UNION ALL SELECT '*', '2 of 6 scaled', true""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "value", "user_id",
        F.lit(3.0).alias("constant"),
        F.lit(None).cast("double").alias("empty"),
        (F.col("event_id") % 2).alias("flag"),
    )
    return Scale(ScaleSettings(skip=("event_id",))).fit(events).report(spark)


@query(
    "scaling_stats",
    """SELECT 'value' AS "column", count(*) AS n_samples, round(avg(value), 6) AS mean,
              round(stddev_pop(value), 6) AS std, min(value) AS min, max(value) AS max, false AS is_constant
       FROM events
       UNION ALL SELECT 'empty', 0, NULL, NULL, NULL, NULL, false
       UNION ALL SELECT 'constant', count(*), 3, 0, 3, 3, true FROM events
       UNION ALL SELECT 'infinite', count(*), round(avg(value), 6), round(stddev_pop(value), 6),
                        min(value), max(value), false FROM events WHERE event_id % 40 <> 0""",
)
def _(spark, sf_dir):
    infinite = F.when(F.col("event_id") % 40 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    events = table(spark, sf_dir, "events").select(
        "value",
        F.lit(None).cast("double").alias("empty"),
        F.lit(3.0).alias("constant"),
        infinite.alias("infinite"),
    )
    return _rounded(scaling_stats(events, events.columns), "mean", "std")


@query(
    "scaling_report",
    f"""WITH judged AS (
          SELECT * FROM (VALUES ('l_extendedprice', 'standard'), ('l_discount', 'minmax'), ('l_quantity', 'robust'),
                                ('l_orderkey', 'user_skip'), ('l_linenumber', 'user_skip')) AS listed("column", method)
          UNION ALL SELECT c, CASE WHEN odd THEN 'robust' ELSE 'standard' END FROM ({SHAPE.format(c="l_tax", t="lineitem")})
          UNION ALL SELECT 'is_outlier_q', CASE WHEN count(DISTINCT (l_quantity > 25)::INT) <= 2 THEN 'flag_skip' ELSE 'standard' END FROM lineitem),
        known AS (SELECT "column", method, method IN ('standard', 'minmax', 'robust') AS scaled FROM judged)
        SELECT * FROM known
        UNION ALL SELECT '*', sum(scaled::INT)::BIGINT || ' of ' || count(*) || ' scaled', sum(scaled::INT) > 0 FROM known""",
)
def _(spark, sf_dir):
    return _mixed(spark, sf_dir)[1].report(spark)
