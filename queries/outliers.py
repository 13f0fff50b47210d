"""Outlier detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.outlier_profile import (
    OutlierProfile, ProfileSettings, SmartOutliers, SmartSettings, distribution_stats,
)
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from queries.registry import DIRTY, dirty_events, query, r6, table


def _flags(df, key: list[str], *rules: OutlierRule, row_id: str | None = None):
    settings = OutlierSettings(tuple(rules), row_id=row_id)
    names = sorted({r.column for r in rules})
    narrow = df.select(*key, *(c for c in names if c not in key))
    marked = Outliers(settings).fit(narrow).mark(narrow)
    return marked.select(*key, *(f"is_outlier_{c}" for c in names))


@query(
    "outlier_zscore",
    f"""WITH {DIRTY}, b AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM dirty)
        SELECT event_id, coalesce(abs(value - m) / s > 3, false) AS is_outlier_value FROM dirty, b""",
)
def _(spark, sf_dir):
    rule = OutlierRule("value", "zscore", threshold=3)
    return _flags(dirty_events(spark, sf_dir), ["event_id"], rule)


@query(
    "outlier_iqr",
    """WITH b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS p1, quantile_cont(l_extendedprice, 0.75) AS p3,
                         quantile_cont(l_discount, 0.25) AS d1, quantile_cont(l_discount, 0.75) AS d3
                  FROM lineitem)
       SELECT l_orderkey, l_linenumber,
              l_extendedprice < p1 - 0.5 * (p3 - p1) OR l_extendedprice > p3 + 0.5 * (p3 - p1)
                AS is_outlier_l_extendedprice,
              l_discount < d1 - 0.25 * (d3 - d1) OR l_discount > d3 + 0.25 * (d3 - d1)
                AS is_outlier_l_discount
       FROM lineitem, b""",
)
def _(spark, sf_dir):
    return _flags(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        OutlierRule("l_extendedprice", "iqr", threshold=0.5),
        OutlierRule("l_discount", "iqr", threshold=0.25),
    )


@query(
    "outlier_quantile",
    f"""WITH {DIRTY}, b AS (
          SELECT quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.9) AS hi FROM dirty)
        SELECT event_id, coalesce(value < lo OR value > hi, false) AS is_outlier_value FROM dirty, b""",
)
def _(spark, sf_dir):
    return _flags(dirty_events(spark, sf_dir), ["event_id"], OutlierRule("value", "robust"))


@query(
    "outlier_mad",
    f"""WITH {DIRTY}, b AS (SELECT median(value) AS med, mad(value) AS spread FROM dirty)
        SELECT event_id, coalesce(abs(0.6745 * (value - med)) / spread > 3, false) AS is_outlier_value
        FROM dirty, b""",
)
def _(spark, sf_dir):
    return _flags(dirty_events(spark, sf_dir), ["event_id"], OutlierRule("value", "mad"))


@query(
    "outlier_range",
    f"""WITH {DIRTY} SELECT event_id, coalesce(value < 1 OR value > 100, false) AS is_outlier_value
        FROM dirty""",
)
def _(spark, sf_dir):
    rule = OutlierRule("value", "minmax_business", feature_range_business=(1, 100))
    return _flags(dirty_events(spark, sf_dir), ["event_id"], rule)


@query(
    "outlier_custom",
    f"""WITH {DIRTY} SELECT event_id, coalesce(value < 5, false) AS is_outlier_value FROM dirty""",
)
def _(spark, sf_dir):
    rule = OutlierRule("value", "custom", detect_function=lambda x: x < 5)
    return _flags(dirty_events(spark, sf_dir), ["event_id"], rule)


@query("outlier_iforest")
def _(spark, sf_dir):
    rule = OutlierRule("value", "isolationforest", contamination=0.025, random_state=42)
    return _flags(dirty_events(spark, sf_dir), ["event_id"], rule, row_id="event_id")


PROFILE_BOUNDS = f"""WITH {DIRTY}, b AS (
  SELECT avg(value) AS vm, stddev_samp(value) AS vs, avg(user_id) AS um, stddev_samp(user_id) AS us
  FROM dirty), z AS (
  SELECT event_id, abs((value - vm) / vs) AS zv, abs((user_id - um) / us) AS zu FROM dirty, b)"""


def _profile(spark, sf_dir):
    events = dirty_events(spark, sf_dir).select("event_id", "value", "user_id")
    settings = ProfileSettings("zscore", 1.5, columns=("value", "user_id"))
    return events, OutlierProfile(settings).fit(events)


@query(
    "outlier_profile",
    f"""{PROFILE_BOUNDS} SELECT event_id, coalesce(zv >= 1.5, false) OR coalesce(zu >= 1.5, false)
          AS is_outliers FROM z""",
)
def _(spark, sf_dir):
    events, model = _profile(spark, sf_dir)
    return model.transform(events).select("event_id", "is_outliers")


@query(
    "outlier_details",
    f"""{PROFILE_BOUNDS}, t AS (
          SELECT event_id, 'value' AS tag, zv AS score, 0 AS i FROM z WHERE zv >= 1.5
          UNION ALL SELECT event_id, 'user_id', zu, 1 FROM z WHERE zu >= 1.5)
        SELECT event_id, tag, round(score, 6) AS score,
               CAST(row_number() OVER (PARTITION BY event_id ORDER BY i) - 1 AS INT) AS place FROM t""",
)
def _(spark, sf_dir):
    events, model = _profile(spark, sf_dir)
    pairs = F.arrays_zip(F.col("extreme_tag").alias("tag"), F.col("extreme_scores").alias("score"))
    return (
        model.details(events, "event_id")
        .select("event_id", F.posexplode(pairs).alias("place", "pair"))
        .select("event_id", "place", "pair.tag", r6(F.col("pair.score")).alias("score"))
    )


@query(
    "outlier_info",
    f"""{PROFILE_BOUNDS}
        SELECT 'value' AS "column", 'zscore' AS method, count(*) AS outlier_count, 1.5::DOUBLE AS threshold
        FROM z WHERE zv >= 1.5
        UNION ALL SELECT 'user_id', 'zscore', count(*), 1.5::DOUBLE FROM z WHERE zu >= 1.5""",
)
def _(spark, sf_dir):
    events, model = _profile(spark, sf_dir)
    return model.info(events)


# Columns of different shape over all events: right-skewed, flat, symmetric with heavy tails, normal.
SHAPES = ("value", "user_id", "signed", "bell")


def _shaped(spark, sf_dir):
    def uniform(first: int):
        digits = F.substring(F.md5(F.col("event_id").cast("string")), first, 8)
        return (F.conv(digits, 16, 10).cast("double") + 1.0) / 4294967297.0

    bell = F.sqrt(-2.0 * F.log(uniform(1))) * F.cos(F.lit(6.283185307179586) * uniform(9))
    signed = F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(-F.col("value"))
    return table(spark, sf_dir, "events").select(
        "event_id", "value", F.col("user_id").cast("double").alias("user_id"),
        signed.alias("signed"), bell.alias("bell"),
    )


SHAPED = """
shaped AS (
  SELECT event_id, value, user_id::DOUBLE AS user_id,
         CASE WHEN event_id % 2 = 0 THEN value ELSE -value END AS signed,
         sqrt(-2.0::DOUBLE * ln((('0x' || substr(md5(event_id::VARCHAR), 1, 8))::BIGINT + 1.0::DOUBLE) / 4294967297.0::DOUBLE))
           * cos(6.283185307179586::DOUBLE * ((('0x' || substr(md5(event_id::VARCHAR), 9, 8))::BIGINT + 1.0::DOUBLE) / 4294967297.0::DOUBLE)) AS bell
  FROM events),
long AS (UNPIVOT shaped ON value, user_id, signed, bell INTO NAME col VALUE x),
moments AS (
  SELECT col, count(*)::DOUBLE AS n,
         avg(pow(x - m, 3)) / pow(avg(pow(x - m, 2)), 1.5) AS g,
         avg(pow(x - m, 4)) / pow(avg(pow(x - m, 2)), 2) - 3 AS k
  FROM (SELECT col, x, avg(x) OVER (PARTITION BY col) AS m FROM long) GROUP BY col),
z AS (
  SELECT *, g * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
         3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta,
         (k + 3 - 3 * (n - 1) / (n + 1))
           / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS xk,
         6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
           * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS rb
  FROM moments),
z2 AS (
  SELECT *, sqrt(2 * (beta - 1)) - 1 AS w, 6 + 8 / rb * (2 / rb + sqrt(1 + 4 / (rb * rb))) AS a FROM z),
z3 AS (
  SELECT *, asinh(y / sqrt(2 / (w - 1))) / sqrt(0.5 * ln(w)) AS z1, 1 + xk * sqrt(2 / (a - 4)) AS d FROM z2),
shape AS (
  SELECT col, n::BIGINT AS n, g, k,
         exp(-(z1 * z1 + pow((1 - 2 / (9 * a) - sign(d) * pow((1 - 2 / a) / abs(d), 1.0 / 3))
             / sqrt(2 / (9 * a)), 2)) / 2) AS p
  FROM z3),
method AS (
  SELECT *, CASE WHEN n < 10 THEN 'iqr' WHEN p > 0.05 AND abs(g) <= 1 THEN 'zscore'
                 WHEN abs(g) > 1 THEN 'iqr' WHEN k > 3 THEN 'mad' ELSE 'iqr' END AS method,
            CASE WHEN n < 10 THEN 'too few values' WHEN p > 0.05 AND abs(g) <= 1 THEN 'close to normal'
                 WHEN abs(g) > 1 THEN 'skewed' WHEN k > 3 THEN 'heavy tails' ELSE 'default' END AS reason
  FROM shape)"""


@query(
    "distribution_stats",
    f"""WITH {SHAPED} SELECT col AS "column", n AS n_samples, round(g, 6) AS skewness,
          round(k, 6) AS kurtosis, round(p, 6) AS normality_p, p > 0.05 AS is_normal,
          abs(g) > 1 AS is_skewed, k > 3 AS is_heavy_tailed FROM shape""",
)
def _(spark, sf_dir):
    shapes = distribution_stats(_shaped(spark, sf_dir), list(SHAPES))
    return shapes.withColumns({c: r6(F.col(c)) for c in ("skewness", "kurtosis", "normality_p")})


@query(
    "smart_outlier",
    f"""WITH {SHAPED}, b AS (
          SELECT l.col, method, avg(x) AS m, stddev_pop(x) AS s, quantile_cont(x, 0.25) AS q1,
                 quantile_cont(x, 0.75) AS q3, median(x) AS med, mad(x) AS spread
          FROM long l JOIN method USING (col) GROUP BY l.col, method),
        flagged AS (
          SELECT event_id, col, CASE method WHEN 'zscore' THEN abs(x - m) / s > 3
                   WHEN 'mad' THEN abs(0.6745 * (x - med)) / spread > 3
                   ELSE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1) END AS hit
          FROM long JOIN b USING (col))
        SELECT event_id, bool_or(hit) FILTER (col = 'value') AS is_outlier_value,
               bool_or(hit) FILTER (col = 'user_id') AS is_outlier_user_id,
               bool_or(hit) FILTER (col = 'signed') AS is_outlier_signed,
               bool_or(hit) FILTER (col = 'bell') AS is_outlier_bell
        FROM flagged GROUP BY event_id""",
)
def _(spark, sf_dir):
    shaped = _shaped(spark, sf_dir)
    model = SmartOutliers(SmartSettings(SHAPES)).fit(shaped)
    return model.transform(shaped).select("event_id", *(f"is_outlier_{c}" for c in SHAPES))


@query(
    "smart_outlier_report",
    f"""WITH {SHAPED} SELECT col AS "column", method, reason, round(g, 6) AS skewness,
          round(k, 6) AS kurtosis, round(p, 6) AS normality_p FROM method""",
)
def _(spark, sf_dir):
    model = SmartOutliers(SmartSettings(SHAPES)).fit(_shaped(spark, sf_dir))
    report = model.report_methods(spark)
    return report.withColumns({c: r6(F.col(c)) for c in ("skewness", "kurtosis", "normality_p")})


@query(
    "outlier_joint",
    """WITH b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS p1, quantile_cont(l_extendedprice, 0.75) AS p3,
                         quantile_cont(l_quantity, 0.25) AS d1, quantile_cont(l_quantity, 0.75) AS d3
                  FROM lineitem)
       SELECT l_orderkey, l_linenumber,
              CAST(l_extendedprice < p1 - 0.4 * (p3 - p1) OR l_extendedprice > p3 + 0.4 * (p3 - p1)
                OR l_quantity < d1 - 0.4 * (d3 - d1) OR l_quantity > d3 + 0.4 * (d3 - d1) AS INT)
                AS is_entire_outlier
       FROM lineitem, b""",
)
def _(spark, sf_dir):
    columns = ("l_extendedprice", "l_quantity")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    model = OutlierProfile(ProfileSettings("iqr", 0.4, columns)).fit(lines)
    return model.mark(lines).drop(*columns)
