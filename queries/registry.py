"""Names, callables and oracles of all queries, and the tables they read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say the same, its oracle."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(value: Column) -> Column:
    return F.round(value, 6)


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events; some values missing or ten times too large, some users and types missing."""
    key, value = F.col("event_id"), F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.when(key % 11 != 0, F.col("user_id")).alias("user_id"),
        F.when(key % 7 != 0, F.col("event_type")).alias("event_type"),
        F.when(key % 17 == 0, F.lit(None)).when(key % 101 == 0, value * 10).otherwise(value).alias("value"),
    )


DIRTY = """
dirty AS (
  SELECT event_id, ts,
         CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id,
         CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_id % 17 = 0 THEN NULL
              WHEN event_id % 101 = 0 THEN value * 10 ELSE value END AS value
  FROM events)"""


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders; some priorities misspelt or written as a null token."""
    key, text = F.col("o_orderkey"), F.col("o_orderpriority")
    spelt = (
        F.when(key % 23 == 0, "N/A")
        .when(key % 29 == 0, " null ")
        .when(key % 211 == 0, F.lower(text))
        .when(key % 307 == 0, F.expr("substring(o_orderpriority, 1, length(o_orderpriority) - 1)"))
        .otherwise(text)
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text, spelt.alias("priority"), "o_orderstatus"
    )


DIRTY_ORDERS = """
spelt AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus,
         CASE WHEN o_orderkey % 23 = 0 THEN 'N/A'
              WHEN o_orderkey % 29 = 0 THEN ' null '
              WHEN o_orderkey % 211 = 0 THEN lower(o_orderpriority)
              WHEN o_orderkey % 307 = 0 THEN substr(o_orderpriority, 1, length(o_orderpriority) - 1)
              ELSE o_orderpriority END AS priority
  FROM orders)"""
