"""Derived features: wind, time, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.profiling import label_correlation
from millrace.operators.selection import SelectByCorrelation, SelectSettings
from millrace.operators.timefeatures import (
    TEXT_FORMATS, TimeFeatures, TimeFeatureSettings, detect_time_types, find_time_column,
    format_scores, parse_success_rate, parse_text, parse_time, wind_vector,
)
from queries.registry import query, r6, table


@query(
    "wind_vector",
    """SELECT event_id, round(value * cos(radians((event_id * 37) % 360)), 6) AS "max. wv_x",
              round(value * sin(radians((event_id * 37) % 360)), 6) AS "max. wv_y",
              round(value / 2 * cos(radians((event_id * 37) % 360)), 6) AS wv_x,
              round(value / 2 * sin(radians((event_id * 37) % 360)), 6) AS wv_y FROM events""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        ((F.col("event_id") * 37) % 360).alias("wd"),
        (F.col("value") / 2).alias("wv"),
        F.col("value").alias("max. wv"),
    )
    wind = wind_vector(events, ["wd"], ["wv", "max. wv", "absent"])
    made = ["wv_x", "wv_y", "max. wv_x", "max. wv_y"]
    return wind.select("event_id", *(r6(F.col(f"`{c}`")).alias(c) for c in made))


def _time_spellings(spark, sf_dir):
    """Every event's time as unix seconds, unix milliseconds, Excel day and two kinds of text."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("stamp"),
        F.floor(micros / 1_000_000).alias("seconds"),
        F.floor(micros / 1000).alias("millis"),
        (F.floor(micros / 1_000_000) / 86400.0 + 25569).alias("excel"),
        F.date_format("ts", "MM/dd/yyyy HH:mm:ss").alias("us_text"),
        F.date_format("ts", "dd.MM.yyyy HH:mm:ss").alias("eu_text"),
        "value",
        "user_id",
    )


NUMERIC_TIMES = """numeric_times AS (
  SELECT event_id, 1700000000 + event_id * 600 AS seconds, (1700000000 + event_id * 600) * 1000 AS millis,
         45000 + event_id / 1000.0::DOUBLE AS excel, 1700000000 + (event_id * 7919 % 1000003) * 600 AS shuffled,
         CASE WHEN event_id < (SELECT max(event_id) // 4 FROM events) THEN 1700000000 + event_id * 600
              ELSE 1900000000 + (event_id * 7919 % 100003) * 60 END AS late_random,
         epoch_us(ts) // 1000000 AS arrival, user_id FROM events)"""


def _numeric_times(spark, sf_dir):
    """Regular, shuffled, partly random and irregular numbers that look like times."""
    key, micros = F.col("event_id"), F.unix_micros(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events")
    last = events.agg(F.expr("max(event_id) div 4").alias("early"))
    regular = F.lit(1_700_000_000) + key * 600
    late = F.lit(1_900_000_000) + F.pmod(key * 7919, F.lit(100_003)) * 60
    return events.join(F.broadcast(last)).select(
        "event_id",
        regular.alias("seconds"),
        (regular * 1000).alias("millis"),
        (F.lit(45_000) + key / 1000.0).alias("excel"),
        (F.lit(1_700_000_000) + F.pmod(key * 7919, F.lit(1_000_003)) * 600).alias("shuffled"),
        F.when(key < F.col("early"), regular).otherwise(late).alias("late_random"),
        F.floor(micros / 1_000_000).alias("arrival"),
        "user_id",
    )


def _kind_sql(name: str) -> str:
    """Digits, rise and pace of one column, from all its values."""
    return f"""(
  WITH v AS (SELECT {name}::DOUBLE AS x, {name}::DOUBLE - lag({name}::DOUBLE) OVER (ORDER BY event_id, {name}) AS d FROM numeric_times),
       m AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, min(d) AS least, median(d) AS mid, bool_and(x = floor(x)) AS whole FROM v),
       s AS (SELECT median(abs(d - mid)) AS away FROM v, m)
  SELECT '{name}' AS "column", CASE WHEN least < 0 OR mid <= 0 OR away / mid > 0.5 THEN 'unknown_numeric'
         WHEN whole AND (lo >= 1e9 AND hi < 1e10 OR lo >= 1e12 AND hi < 1e13) THEN 'unix_timestamp'
         WHEN lo >= 10000 AND hi < 100000 THEN 'excel_date' ELSE 'unknown_numeric' END AS kind, n FROM m, s)"""


NUMERIC_NAMES = ("arrival", "excel", "late_random", "millis", "seconds", "shuffled", "user_id")


@query(
    "detect_time_type",
    f"WITH {NUMERIC_TIMES} SELECT * FROM ({' UNION ALL '.join(map(_kind_sql, NUMERIC_NAMES))})",
)
def _(spark, sf_dir):
    spelt = _numeric_times(spark, sf_dir)
    kinds = detect_time_types(spelt, list(NUMERIC_NAMES), order_by="event_id")
    cells = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind")) for c, k in kinds.items()]
    counted = spelt.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.inline(F.array(*cells)), "n")


@query(
    "find_time_column",
    """SELECT 'ts' AS "column", min(ts) AS first, max(ts) AS last FROM events
       UNION ALL SELECT 'us_text', min(date_trunc('second', ts)), max(date_trunc('second', ts)) FROM events""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    spelt = _time_spellings(spark, sf_dir).select("value", "user_id", "us_text")
    typed, text = find_time_column(events), find_time_column(spelt)
    first = events.agg(
        F.lit(typed).alias("column"), F.min(typed).alias("first"), F.max(typed).alias("last")
    )
    stamp = parse_text(text, "%m/%d/%Y %H:%M:%S")
    return first.unionByName(
        spelt.agg(F.lit(text).alias("column"), F.min(stamp).alias("first"), F.max(stamp).alias("last"))
    )


@query(
    "parse_time",
    """SELECT event_id, date_trunc('second', ts) AS seconds, date_trunc('millisecond', ts) AS millis,
              date_trunc('second', ts) AS excel, date_trunc('second', ts) AS us_text,
              date_trunc('second', ts) AS eu_text FROM events""",
)
def _(spark, sf_dir):
    spelt = _time_spellings(spark, sf_dir)
    excel = parse_time(spelt, "excel", "excel_date")
    return spelt.select(
        "event_id",
        parse_time(spelt, "seconds", "unix_timestamp").alias("seconds"),
        parse_time(spelt, "millis", "unix_timestamp").alias("millis"),
        F.date_trunc("second", excel + F.expr("interval 1 millisecond")).cast("timestamp_ntz").alias("excel"),
        parse_time(spelt, "us_text", "string", "%m/%d/%Y %H:%M:%S").alias("us_text"),
        parse_time(spelt, "eu_text", "string", "%d.%m.%Y %H:%M:%S").alias("eu_text"),
    )


def _mixed_text(spark, sf_dir):
    key = F.col("event_id")
    text = F.when(key % 13 == 0, "not a date").when(key % 5 == 0, F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, sf_dir, "events").select(
        text.otherwise(F.date_format("ts", "dd.MM.yyyy HH:mm:ss")).alias("text")
    )


@query(
    "detect_time_format",
    """SELECT '%d.%m.%Y %H:%M:%S' AS format, count(*) FILTER (event_id % 13 <> 0 AND event_id % 5 <> 0) AS n_parsed
       FROM events UNION ALL
       SELECT '%Y-%m-%d', count(*) FILTER (event_id % 13 <> 0 AND event_id % 5 = 0) FROM events""",
)
def _(spark, sf_dir):
    scores = format_scores(_mixed_text(spark, sf_dir), ["text"], TEXT_FORMATS)["text"]
    rows = [(f, s["parsed"]) for f, s in scores.items() if s["parsed"]]
    return spark.createDataFrame(rows, "format string, n_parsed long")


@query(
    "parse_success_rate",
    """SELECT count(*) AS n_rows, count(*) AS n_values,
              count(*) FILTER (event_id % 13 <> 0 AND event_id % 5 <> 0) AS n_parsed,
              round(count(*) FILTER (event_id % 13 <> 0 AND event_id % 5 <> 0) / count(*), 6) AS success_rate
       FROM events""",
)
def _(spark, sf_dir):
    rate = parse_success_rate(_mixed_text(spark, sf_dir), "text", "%d.%m.%Y %H:%M:%S")
    return rate.withColumn("success_rate", r6(F.col("success_rate")))


def _cycle(name: str, period: str) -> str:
    angle = f"s * (2 * pi() / ({period}))"
    return f"round(sin({angle}), 6) AS {name}_sin, round(cos({angle}), 6) AS {name}_cos"


YEAR = "365.2425::DOUBLE * 86400"
FEATURES = f"""
  CAST(hour(t) >= 20 OR hour(t) <= 5 AS TINYINT) AS is_night,
  CASE WHEN month(t) IN (12, 1, 2) THEN 'winter' WHEN month(t) IN (3, 4, 5) THEN 'spring'
       WHEN month(t) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
  since AS timedelta, since / 86400 AS days_since_start, since / ({YEAR}) AS years_since_start,
  {_cycle("Day", "86400::DOUBLE")}, {_cycle("Month", f"{YEAR} / 12")}, {_cycle("Year", YEAR)}"""
MICROS = "epoch_us({t})"

CYCLES = ["Day_sin", "Day_cos", "Month_sin", "Month_cos", "Year_sin", "Year_cos"]


@query(
    "time_features",
    f"""WITH e AS (SELECT o_orderkey, o_orderdate AS t, {MICROS.format(t="o_orderdate")} AS us FROM orders),
             f AS (SELECT *, (us - min(us) OVER ()) / 1000000.0::DOUBLE AS since, us / 1000000.0::DOUBLE AS s FROM e)
        SELECT o_orderkey, t AS o_orderdate, {FEATURES} FROM f""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    made = TimeFeatures(TimeFeatureSettings("o_orderdate")).fit_transform(orders)
    return made.withColumns({c: r6(F.col(c)) for c in CYCLES})


@query(
    "time_features_from_text",
    f"""WITH e AS (SELECT event_id, date_trunc('second', ts) AS t,
                          {MICROS.format(t="date_trunc('second', ts)")} AS us FROM events),
             f AS (SELECT *, (us - min(us) OVER ()) / 1000000.0::DOUBLE AS since, us / 1000000.0::DOUBLE AS s FROM e)
        SELECT event_id, t AS eu_text, {FEATURES} FROM f""",
)
def _(spark, sf_dir):
    spelt = _time_spellings(spark, sf_dir).select("event_id", "eu_text")
    made = TimeFeatures(TimeFeatureSettings("eu_text")).fit_transform(spelt)
    return made.withColumns({c: r6(F.col(c)) for c in CYCLES})


LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_tax"]


@query(
    "label_correlation",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(corr({c}, l_extendedprice), 6) AS correlation FROM lineitem"""
        for c in LINE_NUMBERS
    ),
)
def _(spark, sf_dir):
    found = label_correlation(table(spark, sf_dir, "lineitem"), "l_extendedprice", LINE_NUMBERS)
    return found.withColumn("correlation", r6(F.col("correlation")))


def _eta(c: str) -> str:
    return f"""SELECT '{c}' AS "column", sqrt(sum(n * pow(g - m, 2)) / max(total)) AS strength
      FROM (SELECT count(*) AS n, avg(y) AS g FROM base WHERE {c} IS NOT NULL GROUP BY {c}),
           (SELECT avg(y) AS m, var_pop(y) * count(*) AS total FROM base WHERE {c} IS NOT NULL)"""


@query(
    "select_by_correlation",
    f"""WITH base AS (SELECT *, l_extendedprice AS y, epoch_us(l_shipdate)::DOUBLE AS ship FROM lineitem),
        s AS (
          {" UNION ALL ".join(f'SELECT {chr(39)}{c}{chr(39)} AS "column", abs(corr({c}, y)) AS strength FROM base' for c in LINE_NUMBERS)}
          UNION ALL SELECT 'l_shipdate', abs(corr(ship, y)) FROM base
          UNION ALL {_eta("l_returnflag")} UNION ALL {_eta("l_linestatus")})
        SELECT "column", round(strength, 6) AS strength, strength >= 0.01 AS kept,
               (SELECT count(*) FROM lineitem) AS n_rows FROM s""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_NUMBERS, "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    model = SelectByCorrelation(SelectSettings("l_extendedprice", 0.01)).fit(lines)
    selected = model.transform(lines)
    rows = [(c, round(s["strength"], 6), c in selected.columns) for c, s in model.state.items()]
    cells = [
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("strength"), F.lit(k).alias("kept"))
        for c, s, k in rows
    ]
    counted = selected.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.inline(F.array(*cells)), "n_rows")


@query(
    "selected_columns",
    "SELECT l_extendedprice, l_quantity FROM lineitem",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", "l_tax")
    settings = SelectSettings("l_extendedprice", 0.9, keep=("l_quantity",))
    return SelectByCorrelation(settings).fit(lines).transform(lines)
