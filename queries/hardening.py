"""Operators on values that break naive code: infinities, sentinel times, large integers, failing rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.casting import CastNumeric, CastNumericSettings
from millrace.operators.evaluation import binary_metrics, regression_metrics
from millrace.operators.missing import FillMissing, FillSettings
from millrace.operators.outlier_profile import OutlierProfile, ProfileSettings
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from millrace.operators.sampling import SystematicSample
from millrace.operators.splitting import TimeSplit
from millrace.plans.order import with_position
from millrace.plans.quantiles import quantiles
from queries.registry import query, r6, table

ENDLESS = """endless AS (
  SELECT event_id, CASE WHEN event_id % 397 = 0 THEN 'inf'::DOUBLE WHEN event_id % 389 = 0 THEN '-inf'::DOUBLE
                        ELSE value END AS value FROM events),
known AS (SELECT avg(value) AS mean, stddev_pop(value) AS std, stddev_samp(value) AS spread, median(value) AS mid,
                 quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM endless WHERE isfinite(value))"""


def _endless(spark, sf_dir):
    """All events, some values infinite."""
    key = F.col("event_id")
    value = F.when(key % 397 == 0, float("inf")).when(key % 389 == 0, float("-inf")).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))


def _judged(spark, sf_dir, method: str, handle: str, threshold: float):
    rule = OutlierRule("value", method, handle, threshold=threshold)
    events = _endless(spark, sf_dir)
    return Outliers(OutlierSettings((rule,), ("value",))).fit_transform(events)


@query(
    "zscore_infinite",
    f"""WITH {ENDLESS} SELECT event_id,
          round(CASE WHEN value < mean - 2 * std THEN mean - 2 * std WHEN value > mean + 2 * std THEN mean + 2 * std
                     ELSE value END, 6) AS value,
          CAST(abs(value - mean) / std > 2 AS INT) AS is_outlier_value FROM endless, known""",
)
def _(spark, sf_dir):
    return _judged(spark, sf_dir, "zscore", "clip", 2.0).withColumn("value", r6(F.col("value")))


@query(
    "iqr_infinite",
    f"""WITH {ENDLESS}, bounds AS (SELECT q1 - 0.5 * (q3 - q1) AS lo, q3 + 0.5 * (q3 - q1) AS hi FROM known)
        SELECT event_id, round(CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END, 6) AS value,
               CAST(value < lo OR value > hi AS INT) AS is_outlier_value FROM endless, bounds""",
)
def _(spark, sf_dir):
    return _judged(spark, sf_dir, "iqr", "clip", 0.5).withColumn("value", r6(F.col("value")))


@query(
    "profile_infinite",
    f"""WITH {ENDLESS} SELECT event_id, abs(value - mean) / spread >= 1.5 AS is_outliers FROM endless, known""",
)
def _(spark, sf_dir):
    settings = ProfileSettings("zscore", 1.5, ("value",))
    return OutlierProfile(settings).fit_transform(_endless(spark, sf_dir)).drop("value")


@query(
    "quantiles_infinite",
    f"""WITH {ENDLESS} SELECT 0.0::DOUBLE AS share, min(value) AS few, min(value) AS many FROM endless
        UNION ALL SELECT 1.0::DOUBLE, max(value), max(value) FROM endless
        UNION ALL SELECT 0.5::DOUBLE, median(value), median(value) FROM endless""",
)
def _(spark, sf_dir):
    """The same quantiles by Spark's percentile and by the narrowing search, infinities included."""
    events, shares = _endless(spark, sf_dir), [0.0, 0.5, 1.0]
    few = quantiles(events, {"v": (F.col("value"), shares)}, small=10**12)["v"]
    many = quantiles(events, {"v": (F.col("value"), shares)}, small=0)["v"]
    rows = F.array(*(
        F.struct(F.lit(s).alias("share"), F.lit(a).alias("few"), F.lit(b).alias("many"))
        for s, a, b in zip(shares, few, many, strict=True)
    ))
    whole = events.agg(F.count(F.lit(1)).alias("n")).select(F.explode(rows).alias("r"))
    return whole.select("r.share", "r.few", "r.many")


@query(
    "impute_after_zscore",
    f"""WITH {ENDLESS} SELECT event_id, round(CASE WHEN abs(value - mean) / std > 2 THEN mid ELSE value END, 6) AS value
        FROM endless, known""",
)
def _(spark, sf_dir):
    events = _endless(spark, sf_dir)
    marked = Outliers(OutlierSettings((OutlierRule("value", "zscore", threshold=2.0),))).fit(events)
    return marked.repair_all(events, "impute").withColumn("value", r6(F.col("value")))


@query("failing_detector", "SELECT event_id, CAST(value > 50 AS INT) AS is_outlier_value FROM events")
def _(spark, sf_dir):
    """A detector that raises is reported and its column left alone; the others go on."""
    def broken(value):
        raise RuntimeError("no detector")

    events = table(spark, sf_dir, "events").select("event_id", "value", "user_id")
    rules = (
        OutlierRule("user_id", "custom", "nan", detect_function=broken),
        OutlierRule("value", "custom", "mark", detect_function=lambda value: value > 50),
    )
    return Outliers(OutlierSettings(rules)).fit_transform(events).select("event_id", "is_outlier_value")


SENTINEL = """late AS (
  SELECT event_id, value, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '9999-12-31 23:59:59.999999'
                               WHEN event_id % 17 = 0 THEN TIMESTAMP '0001-01-01 00:00:00' + to_seconds(event_id % 5)
                               WHEN event_id % 19 <> 0 THEN ts END AS ts FROM events),
placed AS (SELECT *, row_number() OVER (ORDER BY ts NULLS FIRST, event_id) - 1 AS pos, count(*) OVER () AS n FROM late)"""


def _sentinel_times(spark, sf_dir):
    """All events; a third at the last possible instant, some in the year 1, some without a time."""
    key = F.col("event_id")
    early = F.expr("timestamp_ntz'0001-01-01 00:00:00' + make_dt_interval(0, 0, 0, event_id % 5)")
    time = F.when(key % 3 == 0, F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz")).when(key % 17 == 0, early)
    own = F.when(key % 19 != 0, F.col("ts").cast("timestamp_ntz"))
    return table(spark, sf_dir, "events").select("event_id", "value", time.otherwise(own).alias("ts"))


@query("position_sentinel", f"WITH {SENTINEL} SELECT event_id, pos FROM placed")
def _(spark, sf_dir):
    return with_position(_sentinel_times(spark, sf_dir), "ts", "event_id", buckets=40).select("event_id", "pos")


@query("sample_sentinel", f"WITH {SENTINEL} SELECT event_id FROM placed WHERE pos >= 5 AND (pos - 5) % 6 = 0")
def _(spark, sf_dir):
    return SystematicSample(5, 6).apply(_sentinel_times(spark, sf_dir), "ts", "event_id").select("event_id")


@query(
    "fill_sentinel",
    f"""WITH {SENTINEL} SELECT event_id, round(last_value(CASE WHEN event_id % 7 <> 0 THEN value END IGNORE NULLS)
          OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value FROM placed""",
)
def _(spark, sf_dir):
    holes = _sentinel_times(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    settings = FillSettings(rules={"value": "ffill"}, time="ts", row_id="event_id")
    return FillMissing(settings).fit_transform(holes).select("event_id", r6(F.col("value")).alias("value"))


@query(
    "split_sentinel",
    f"""WITH {SENTINEL}, cut AS (SELECT *, floor(n * 0.7 + 0.5) AS a, floor(n * 0.2 + 0.5) AS b FROM placed)
        SELECT event_id, CASE WHEN pos < a THEN 'train' WHEN pos < a + b THEN 'val' ELSE 'test' END AS split FROM cut""",
)
def _(spark, sf_dir):
    split = TimeSplit().with_params(train=0.7, val=0.2, test=0.1)
    return split.apply(_sentinel_times(spark, sf_dir), "ts", "event_id").select("event_id", "split")


@query(
    "cast_unseen",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN event_id
                             ELSE user_id END AS user_id FROM events""",
)
def _(spark, sf_dir):
    """Learned as whole numbers; a broken number later is NULL, a whole one written as 7.0 or 7e0 is kept."""
    events = table(spark, sf_dir, "events")
    learned = CastNumeric(CastNumericSettings(["user_id"])).fit(
        events.select(F.col("user_id").cast("string").alias("user_id")))
    key = F.col("event_id")
    text = F.when(key % 5 == 0, F.concat(key.cast("string"), F.lit(".7")))
    text = text.when(key % 7 == 0, F.concat(key.cast("string"), F.lit(".0"))).otherwise(F.col("user_id").cast("string"))
    return learned.transform(events.select("event_id", text.alias("user_id")))


@query(
    "fill_mode_large",
    """WITH large AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN 9007199254740993 + user_id % 2 END AS code FROM events)
       SELECT event_id, coalesce(code, (SELECT code FROM large WHERE code IS NOT NULL GROUP BY 1
                                        ORDER BY count(*) DESC, 1 LIMIT 1)) AS code FROM large""",
)
def _(spark, sf_dir):
    code = F.when(F.col("event_id") % 3 != 0, F.lit(9_007_199_254_740_993) + F.col("user_id") % 2)
    large = table(spark, sf_dir, "events").select("event_id", code.alias("code"))
    return FillMissing(FillSettings(rules={"code": "mode"})).fit_transform(large).select("event_id", "code")


@query(
    "metrics_nan",
    """WITH j AS (SELECT l.quality AS truth, d.n_chars / (d.n_chars + 900.0::DOUBLE) AS p, d.n_chars::DOUBLE AS y,
                         d.n_chars * 0.9::DOUBLE AS guess, d.doc_id % 5 = 0 AS lost
                  FROM documents d JOIN labels l USING (doc_id))
       SELECT count(*) AS n, count(*) FILTER (truth = 1 AND p > 0.5) AS tp, count(*) FILTER (truth = 0 AND p > 0.5) AS fp,
              round(avg(-CASE WHEN truth = 1 THEN ln(p) ELSE ln(1 - p) END), 6) AS log_loss,
              round(avg(abs(guess - y)), 6) AS mae, round(max(guess), 6) AS pred_max FROM j WHERE NOT lost""",
)
def _(spark, sf_dir):
    """A NaN forecast or probability is a missing one."""
    size, lost = F.col("n_chars"), F.col("doc_id") % 5 == 0
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(
        F.col("quality").alias("truth"), size.cast("double").alias("y"),
        F.when(lost, float("nan")).otherwise(size / (size + 900.0)).alias("p"),
        F.when(lost, float("nan")).otherwise(size * F.lit(0.9)).alias("guess"),
    )
    judged = binary_metrics(joined, "truth", "p").select("n", "tp", "fp", r6(F.col("log_loss")).alias("log_loss"))
    gaps = regression_metrics(joined, "y", "guess").select(F.col("n").alias("m"), r6(F.col("mae")).alias("mae"), r6(F.col("pred_max")).alias("pred_max"))
    return judged.join(gaps, F.col("n") == F.col("m")).drop("m")


@query(
    "iforest_properties",
    """SELECT count(*) AS n, count(*) FILTER (event_id % 499 = 0) AS planted, count(*) FILTER (event_id % 499 = 0) AS found,
              0::BIGINT AS over, 0::BIGINT AS mixed FROM events""",
)
def _(spark, sf_dir):
    """Far values are found, no more rows than the contamination are flagged, equal values get equal flags."""
    key, share = F.col("event_id"), 0.02
    value = F.when(key % 499 == 0, F.lit(1e7) + key).otherwise(F.col("value"))
    events = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    rule = OutlierRule("value", "isolationforest", contamination=share)
    marked = Outliers(OutlierSettings((rule,), row_id="event_id")).fit_transform(events)
    flag, planted = F.col("is_outlier_value"), key % 499 == 0
    by_value = marked.groupBy("value").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(planted).alias("planted"), F.count_if(planted & (flag == 1)).alias("found"),
        F.sum(flag).alias("flagged"))
    mixed = (F.col("flagged") > 0) & (F.col("flagged") < F.col("n"))
    return by_value.agg(
        F.sum("n").alias("n"), F.sum("planted").alias("planted"), F.sum("found").alias("found"),
        F.greatest(F.lit(0), F.sum("flagged") - F.floor(F.sum("n") * share)).cast("long").alias("over"),
        F.count_if(mixed).alias("mixed"))
