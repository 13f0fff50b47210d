"""Sources, sinks, guards, profiles and casts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.functions.columns import nan_to_null
from millrace.operators.casting import (
    CastNumeric, CastNumericSettings, OneHot, OneHotSettings, Sentinel, cast_categorical,
    fix_sentinels, sort_by_time,
)
from millrace.operators.dedup import duplicate_rows
from millrace.operators.outlier_profile import OutlierProfile, ProfileSettings
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from millrace.operators.profiling import column_types_table, describe_columns, describe_table, drop_useless_columns
from millrace.operators.scaling import Scale
from millrace.session import shared_folder
from millrace.sources.tables import SideOutput, load_tables, require_valid
from queries.registry import DIRTY, dirty_events, query, r6, table


@query("load_tables", "SELECT * FROM orders UNION ALL BY NAME SELECT * FROM customer")
def _(spark, sf_dir):
    return load_tables(spark, ["orders.parquet"], "custom*.parquet", sf_dir)


@query(
    "require_valid",
    "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def _(spark, sf_dir):
    checked = require_valid(table(spark, sf_dir, "lineitem"), ["l_quantity"], "l_extendedprice")
    return checked.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "nan_to_null",
    "SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN value END AS value FROM events",
)
def _(spark, sf_dir):
    value = F.when(F.col("event_id") % 17 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return nan_to_null(table(spark, sf_dir, "events").select("event_id", value.alias("value")))


def _side(spark, filename: str) -> SideOutput:
    return SideOutput(True, f"{shared_folder(spark)}/{uuid.uuid4().hex}", filename)


@query(
    "write_duplicates",
    """SELECT doc_id, lang, source, n_chars, md5(text) AS digest FROM (
         SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) AS rn FROM documents)
       WHERE rn > 1""",
)
def _(spark, sf_dir):
    copies = duplicate_rows(table(spark, sf_dir, "documents"), "doc_id", ["text", "lang"])
    written = _side(spark, "duplicate_rows.parquet").write(copies)
    return written.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("digest"))


@query(
    "write_outliers",
    f"""WITH {DIRTY}, b AS (
          SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM dirty)
        SELECT event_id, 'value' AS tag, round(value, 6) AS score FROM dirty, b
        WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def _(spark, sf_dir):
    events = dirty_events(spark, sf_dir)
    profile = OutlierProfile(ProfileSettings(columns=("value",))).fit(events)
    written = _side(spark, "outliers.parquet").write(profile.details(events, "event_id"))
    return written.select(
        "event_id",
        F.inline(F.arrays_zip(F.col("extreme_tag").alias("tag"), F.col("extreme_scores").alias("score"))),
    ).withColumn("score", r6(F.col("score")))


def _describe_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS missing,
              count(DISTINCT {c}) AS distinct_values, round(avg({c}), 4) AS mean,
              round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min,
              round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25,
              round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median,
              round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75,
              round(max({c})::DOUBLE, 4) AS max FROM lineitem"""
        for c in columns
    )


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("describe_table", _describe_sql(PROFILED))
def _(spark, sf_dir):
    profile = describe_table(table(spark, sf_dir, "lineitem"), PROFILED)
    doubles = [f.name for f in profile.schema.fields if f.dataType.typeName() == "double"]
    return profile.withColumns({c: F.round(c, 4) for c in doubles})


def _column_sql(name: str, kind: str, value: str) -> str:
    return f"""SELECT '{name}' AS "column", '{kind}' AS kind, count({name}) AS n, count(*) - count({name}) AS missing,
        count(DISTINCT {name}) AS distinct_values, round(min({value})::DOUBLE, 4) AS low, round(max({value})::DOUBLE, 4) AS high,
        round(avg({value}), 4) AS mean, {"NULL" if kind == "numeric" else f"min({name})::VARCHAR"} AS first,
        {"NULL" if kind == "numeric" else f"max({name})::VARCHAR"} AS last FROM kinds"""


@query(
    "describe_columns",
    "WITH kinds AS (SELECT *, o_totalprice > 100000 AS dear FROM orders) " + " UNION ALL ".join((
        _column_sql("o_orderkey", "numeric", "o_orderkey"), _column_sql("o_totalprice", "numeric", "o_totalprice"),
        _column_sql("o_orderdate", "time", "epoch(o_orderdate)"), _column_sql("o_orderpriority", "categorical", "length(o_orderpriority)"),
        _column_sql("o_orderstatus", "categorical", "length(o_orderstatus)"), _column_sql("dear", "boolean", "dear::INT"),
    )),
)
def _(spark, sf_dir):
    """Numbers, times, texts and booleans; the text form of numbers is left out."""
    names = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"]
    orders = table(spark, sf_dir, "orders").select(*names, (F.col("o_totalprice") > 100_000).alias("dear"))
    profile = describe_columns(orders)
    doubles = {c: F.round(c, 4) for c in ("low", "high", "mean")}
    shown = {c: F.when(F.col("kind") != "numeric", F.col(c)) for c in ("first", "last")}
    return profile.withColumns(doubles | shown)


@query("drop_useless_columns", "SELECT event_id, ts, user_id, event_type, value FROM events")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").drop("props")
    return drop_useless_columns(
        events.withColumns({"always": F.lit(7), "never": F.lit(None).cast("double")})
    )


@query(
    "identify_column_types",
    """SELECT 'o_orderkey' AS "column", 'numeric' AS kind, count(o_orderkey) AS n_valid FROM orders
       UNION ALL SELECT 'o_custkey', 'numeric', count(o_custkey) FROM orders
       UNION ALL SELECT 'o_orderstatus', 'categorical', count(o_orderstatus) FROM orders
       UNION ALL SELECT 'o_totalprice', 'numeric', count(o_totalprice) FROM orders
       UNION ALL SELECT 'o_orderdate', 'time', count(o_orderdate) FROM orders
       UNION ALL SELECT 'o_orderpriority', 'categorical', count(o_orderpriority) FROM orders""",
)
def _(spark, sf_dir):
    return column_types_table(table(spark, sf_dir, "orders"))


@query(
    "cast_numeric",
    """SELECT event_id, user_id AS "user-text",
              CASE WHEN event_id % 13 <> 0 THEN value END AS "max. value",
              round(CASE WHEN event_id % 13 <> 0 THEN value END * user_id * (1 - 10 / 100.0), 6) AS price,
              CAST(user_id AS VARCHAR) AS untouched
       FROM events""",
)
def _(spark, sf_dir):
    value = F.when(F.col("event_id") % 13 == 0, "abc").otherwise(F.col("value").cast("string"))
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user-text"),
        value.alias("max. value"),
        F.col("user_id").cast("string").alias("untouched"),
    )
    settings = CastNumericSettings(["user-text", "max. value", "untouched"], exclude_cols=["untouched"])
    cast = CastNumeric(settings).fit_transform(events)
    price = F.col("`max. value`") * F.col("`user-text`") * (1 - F.lit(10) / F.lit(100.0))
    return cast.withColumn("price", r6(price))


@query(
    "cast_categorical",
    "SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS user_id FROM events",
)
def _(spark, sf_dir):
    padded = F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")).alias("event_type")
    events = table(spark, sf_dir, "events").select("event_id", padded, "user_id")
    return cast_categorical(events, ["event_type", "user_id", "absent"])


@query(
    "one_hot",
    """SELECT event_id, (event_type = 'click')::INT AS event_type_click,
              (event_type = 'error')::INT AS event_type_error,
              (event_type = 'purchase')::INT AS event_type_purchase,
              (event_type = 'signup')::INT AS event_type_signup,
              (event_type = 'view')::INT AS event_type_view FROM events""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return OneHot(OneHotSettings(["event_type"])).fit_transform(events)


@query("sort_by_time", "SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def _(spark, sf_dir):
    text = F.date_format("ts", "dd.MM.yyyy HH:mm:ss").alias("ts")
    return sort_by_time(table(spark, sf_dir, "events").select("event_id", text), "ts", row_id="event_id")


@query(
    "fix_sentinels",
    """SELECT event_id, CASE WHEN event_id % 19 <> 0 AND value <= 300 THEN value END AS value
       FROM events""",
)
def _(spark, sf_dir):
    value = F.when(F.col("event_id") % 19 == 0, F.lit(-9999.0)).otherwise(F.col("value"))
    events = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return fix_sentinels(events, {"value": Sentinel((-9999.0,), low=0.0, high=300.0)})


@query(
    "filter_normal_rows",
    f"""WITH {DIRTY}, b AS (
          SELECT avg(value) AS m, stddev_pop(value) AS s, quantile_cont(user_id::DOUBLE, 0.25) AS q1,
                 quantile_cont(user_id::DOUBLE, 0.75) AS q3 FROM dirty)
        SELECT event_id, user_id, round(value, 6) AS value FROM dirty, b
        WHERE NOT (coalesce(abs(value - m) / s > 2, false)
                   OR coalesce(user_id < q1 - 0.5 * (q3 - q1) OR user_id > q3 + 0.5 * (q3 - q1), false))""",
)
def _(spark, sf_dir):
    events = dirty_events(spark, sf_dir).select("event_id", "user_id", "value")
    rules = (
        OutlierRule("value", "zscore", threshold=2), OutlierRule("user_id", "iqr", threshold=0.5),
    )
    model = Outliers(OutlierSettings(rules)).fit(events)
    return model.keep_normal(events).withColumn("value", r6(F.col("value")))


@query("pass_through", "SELECT * FROM lineitem")
def _(spark, sf_dir):
    return Scale(pass_through=True).fit_transform(table(spark, sf_dir, "lineitem"))
