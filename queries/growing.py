"""Fits that grow: a preparation of two thirds of the events, extended by the rest without reading the first again."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from millrace.operators.categories import Categories, CategorySettings
from millrace.operators.mergeable import fit_summary, rank_error, summarize
from millrace.operators.missing import FillMissing, FillSettings
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from millrace.operators.scaling import Scale, ScaleSettings
from millrace.operators.stages import Preparation, Prepared, Stage
from millrace.session import scratch, shared_folder
from queries.registry import DIRTY, dirty_events, query, r6


def _halves(spark, sf_dir):
    events = dirty_events(spark, sf_dir).withColumn("kind", F.col("event_type"))
    return events.where("event_id % 3 <> 0"), events.where("event_id % 3 = 0")


@query(
    "merged_summary",
    f"""WITH {DIRTY} SELECT c AS "column", count(x) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std,
          round(min(x), 6) AS min, round(max(x), 6) AS max, round(skewness(x) * (count(x) - 2) / sqrt(count(x)::DOUBLE * (count(x) - 1)), 5) AS skew
        FROM (SELECT 'value' AS c, value AS x FROM dirty UNION ALL SELECT 'user_id', user_id::DOUBLE FROM dirty) GROUP BY c""",
)
def _(spark, sf_dir):
    """Counts, extremes and moments of a merged summary, against one pass over all rows."""
    old, new = _halves(spark, sf_dir)
    merged = summarize(old, ["value", "user_id"], []).merge(summarize(new, ["value", "user_id"], []))
    stats = merged.statistics({"value": None, "user_id": None}, ["n", "mean", "std", "min", "max", "skew"])
    rows = [(c, s["n"], float(s["mean"]), float(s["std"]), float(s["min"]), float(s["max"]), float(s["skew"])) for c, s in stats.items()]
    found = spark.createDataFrame(rows, "column string, n long, mean double, std double, min double, max double, skew double")
    return found.select("column", "n", *(r6(F.col(c)).alias(c) for c in ("mean", "std", "min", "max")), F.round("skew", 5).alias("skew"))


@query(
    "merged_categories",
    f"""WITH {DIRTY} SELECT event_type AS value, count(*) AS n FROM dirty WHERE event_type IS NOT NULL GROUP BY event_type""",
)
def _(spark, sf_dir):
    old, new = _halves(spark, sf_dir)
    return summarize(old, [], ["event_type"]).merge(summarize(new, [], ["event_type"])).counts(["event_type"]).select("value", "n")


SHARES = (0.01, 0.25, 0.5, 0.75, 0.99)


@query(
    "merged_quantiles",
    f"""WITH {DIRTY} SELECT q AS share, (SELECT count(value) FROM dirty) AS n, true AS within
        FROM (VALUES {", ".join(f"({q}::DOUBLE)" for q in SHARES)}) AS s(q)""",
)
def _(spark, sf_dir):
    """Quantiles of a merged sketch; the exact ranks of all of them lie within the stated error."""
    old, new = _halves(spark, sf_dir)
    merged = summarize(old, ["value"], []).merge(summarize(new, ["value"], []))
    found = merged.quantiles({"value": (None, SHARES)})["value"]
    value = F.col("value")
    counted = [F.array(F.lit(q), F.count_if(value < v).cast("double"), F.count_if(value <= v).cast("double")) for q, v in zip(SHARES, found, strict=True)]
    rows = old.unionByName(new).agg(F.count("value").alias("n"), F.array(*counted).alias("c")).select("n", F.explode("c").alias("c"))
    share, error = F.col("c")[0], F.lit(rank_error())
    within = (F.col("c")[1] <= (share + error) * F.col("n") + 1) & (F.col("c")[2] >= (share - error) * F.col("n") - 1)
    return rows.select(share.alias("share"), "n", within.alias("within"))


def _preparation() -> Preparation:
    clip = Outliers(OutlierSettings((OutlierRule("value", "zscore", "nan", threshold=3.0),)))
    types = Categories(CategorySettings(("kind",), rare_threshold=0.1, auto_correct_typos=False))
    scale = Scale(ScaleSettings.from_dict({"transformers": [{"minmax": {"columns": ["user_id"]}}]}, only_listed=True))
    return Preparation([Stage((clip, types, scale))])


@query(
    "extended_preparation",
    f"""WITH {DIRTY}, known AS (SELECT avg(value) AS m, stddev_pop(value) AS sd, min(user_id) AS lo, max(user_id) AS hi FROM dirty),
        kinds AS (SELECT event_type AS k, count(*) AS n, sum(count(*)) OVER () AS total FROM dirty WHERE event_type IS NOT NULL GROUP BY 1)
        SELECT event_id, round(CASE WHEN abs(value - m) / sd > 3 THEN NULL ELSE value END, 6) AS value,
               CASE WHEN n >= 0.1 * total THEN event_type WHEN event_type IS NOT NULL THEN 'Other' END AS kind,
               round((user_id - lo) / (hi - lo)::DOUBLE, 6) AS user_id
        FROM dirty CROSS JOIN known LEFT JOIN kinds ON k = event_type""",
)
def _(spark, sf_dir):
    """Fitted on two thirds, saved, loaded, extended by the rest, and applied to all rows: as fitted on all."""
    old, new = _halves(spark, sf_dir)
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    with scratch(spark):
        _preparation().fit_transform(old, growing=True)[0].save(spark, path)
        prepared, _ = Prepared.load(spark, path).extend(new)
    whole = prepared.transform(old.unionByName(new))
    return whole.select("event_id", r6(F.col("value")).alias("value"), "kind", r6(F.col("user_id")).alias("user_id"))


@query(
    "merged_fill",
    f"""WITH {DIRTY} SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM dirty)), 6) AS value,
          coalesce(event_type, (SELECT event_type FROM dirty WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS event_type
        FROM dirty""",
)
def _(spark, sf_dir):
    """Means and modes of two summaries fill all rows."""
    old, new = _halves(spark, sf_dir)
    fill = FillMissing(FillSettings({"value": "mean", "event_type": "mode"}))
    columns = fill.summary_columns(old.select("value", "event_type"))
    model = fit_summary(fill, summarize(old, *columns).merge(summarize(new, *columns)))
    filled = model.transform(old.unionByName(new))
    return filled.select("event_id", r6(F.col("value")).alias("value"), "event_type")
