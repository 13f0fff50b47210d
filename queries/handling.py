"""Outlier handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.outlier_profile import OutlierProfile, ProfileSettings
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from queries.registry import DIRTY, dirty_events, query, r6

IQR = f"""WITH {DIRTY}, q AS (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, median(value) AS med,
         avg(value) AS m FROM dirty),
f AS (
  SELECT event_id, user_id, value, med, m, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi,
         coalesce(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1), false) AS hit
  FROM dirty, q)"""


def _fitted(spark, sf_dir, *extra: OutlierRule, indicators=(), **options):
    events = dirty_events(spark, sf_dir).select("event_id", "user_id", "value")
    rule = OutlierRule("value", "iqr", threshold=1.5, **options)
    return events, Outliers(OutlierSettings((rule, *extra), tuple(indicators))).fit(events)


def _values(df, *others: str):
    return df.select("event_id", r6(F.col("value")).alias("value"), *others)


@query("handle_remove", f"{IQR} SELECT event_id, round(value, 6) AS value FROM f WHERE NOT hit")
def _(spark, sf_dir):
    events, model = _fitted(spark, sf_dir)
    return _values(model.keep_normal(events))


@query(
    "handle_mark",
    f"""{IQR} SELECT event_id, hit AS is_outlier_value,
          CAST(hit OR coalesce(user_id < u1 - 0.4 * (u3 - u1) OR user_id > u3 + 0.4 * (u3 - u1), false) AS INT)
            AS is_entire_outlier
        FROM f, (SELECT quantile_cont(user_id::DOUBLE, 0.25) AS u1, quantile_cont(user_id::DOUBLE, 0.75) AS u3
                 FROM dirty)""",
)
def _(spark, sf_dir):
    extra = OutlierRule("user_id", "iqr", threshold=0.4)
    events, model = _fitted(spark, sf_dir, extra)
    joint = model.row_flag(events).cast("int")
    marked = model.mark(events.withColumn("is_entire_outlier", joint))
    return marked.select("event_id", "is_outlier_value", "is_entire_outlier")


@query(
    "handle_impute",
    f"{IQR} SELECT event_id, round(CASE WHEN hit THEN med ELSE value END, 6) AS value FROM f",
)
def _(spark, sf_dir):
    events, model = _fitted(spark, sf_dir, handle="impute")
    return _values(model.transform(events))


@query(
    "handle_null",
    f"{IQR} SELECT event_id, round(CASE WHEN NOT hit THEN value END, 6) AS value FROM f",
)
def _(spark, sf_dir):
    events, model = _fitted(spark, sf_dir, handle="nan")
    return _values(model.transform(events))


@query(
    "handle_null_rows",
    f"""{IQR} SELECT event_id, CASE WHEN NOT hit THEN user_id END AS user_id,
              round(CASE WHEN NOT hit THEN value END, 6) AS value FROM f""",
)
def _(spark, sf_dir):
    events = dirty_events(spark, sf_dir).select("event_id", "user_id", "value")
    model = OutlierProfile(ProfileSettings(columns=("value",))).fit(events)
    return _values(model.blank_rows(events, keep=("event_id",)), "user_id")


@query(
    "handle_clip",
    f"""{IQR} SELECT event_id, round(CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END, 6)
          AS value FROM f""",
)
def _(spark, sf_dir):
    events, model = _fitted(spark, sf_dir, handle="clip")
    return _values(model.transform(events))


@query(
    "handle_constant",
    f"{IQR} SELECT event_id, round(CASE WHEN hit THEN 999 ELSE value END, 6) AS value FROM f",
)
def _(spark, sf_dir):
    events, model = _fitted(spark, sf_dir, handle="constant", constant_value=999)
    return _values(model.transform(events))


@query(
    "handle_custom",
    f"{IQR} SELECT event_id, round(CASE WHEN hit THEN m ELSE value END, 6) AS value FROM f",
)
def _(spark, sf_dir):
    events, model = _fitted(
        spark,
        sf_dir,
        handle="custom",
        handle_function=lambda x, flag, known: F.when(flag, F.lit(known["mean"])).otherwise(x),
    )
    return _values(model.transform(events))


@query(
    "handle_mixed",
    f"""{IQR}, g AS (
          SELECT f.*, coalesce(user_id < 10 OR user_id > 140, false) AS uhit,
                 coalesce(abs(event_id - em) / es > 1.5, false) AS ehit
          FROM f, (SELECT avg(event_id) AS em, stddev_pop(event_id) AS es FROM dirty))
        SELECT event_id, round(CASE WHEN hit THEN 0 ELSE value END, 6) AS value,
               CASE WHEN NOT uhit THEN user_id END AS user_id, CAST(ehit AS INT) AS is_outlier_event_id
        FROM g""",
)
def _(spark, sf_dir):
    events, model = _fitted(
        spark,
        sf_dir,
        OutlierRule("user_id", "minmax_business", feature_range_business=(10, 140)),
        OutlierRule("event_id", "zscore", threshold=1.5),
    )
    mixed = model.mixed(events, {"custom": ["value"], "nan": ["user_id"]})
    return _values(mixed, "user_id", "is_outlier_event_id")


@query(
    "outlier_indicator",
    f"""{IQR} SELECT event_id, round(CASE WHEN NOT hit THEN value END, 6) AS value,
              CAST(hit AS INT) AS is_outlier_value FROM f""",
)
def _(spark, sf_dir):
    events, model = _fitted(spark, sf_dir, handle="nan", indicators=["value"])
    return _values(model.transform(events), "is_outlier_value")


@query(
    "outlier_report",
    f"""{IQR}, g AS (
          SELECT hit, coalesce(value < 5 OR value > 100, false) AS rhit,
                 coalesce(abs(user_id - um) / us > 1.5, false) AS uhit
          FROM f, (SELECT avg(user_id) AS um, stddev_pop(user_id) AS us FROM dirty))
        SELECT '*' AS "column", 'any' AS method, 'mark' AS strategy, count(*) FILTER (hit OR uhit OR rhit) AS outliers FROM g
        UNION ALL SELECT 'value', 'iqr', 'mark', count(*) FILTER (hit) FROM g
        UNION ALL SELECT 'value', 'minmax_business', 'mark', count(*) FILTER (rhit) FROM g
        UNION ALL SELECT 'user_id', 'zscore', 'mark', count(*) FILTER (uhit) FROM g""",
)
def _(spark, sf_dir):
    events, model = _fitted(
        spark,
        sf_dir,
        OutlierRule("value", "minmax_business", feature_range_business=(5, 100)),
        OutlierRule("user_id", "zscore", threshold=1.5),
    )
    return model.report(events)
