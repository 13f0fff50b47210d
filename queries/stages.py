"""Whole preparation runs: staged fitting, and parameters learned on the training part only."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import functions as F

from millrace.operators.dedup import RemoveDuplicates
from millrace.operators.missing import FillMissing, FillSettings
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from millrace.operators.sampling import SystematicSample
from millrace.operators.scaling import Scale, ScaleSettings
from millrace.operators.splitting import TimeSplit
from millrace.operators.stages import Preparation, Prepared, RowStep, Stage
from millrace.operators.timefeatures import TimeFeatures, TimeFeatureSettings
from millrace.session import scratch, shared_folder
from queries.registry import DIRTY, dirty_events, query, r6


def _preparation() -> Preparation:
    """Remove duplicates, clip and fill, take every sixth row, derive time features, scale."""
    clip = Outliers(OutlierSettings((OutlierRule("value", "iqr", "clip", threshold=1.5),)))
    fill = FillMissing(FillSettings({"value": "median"}))
    scale = Scale(ScaleSettings.from_dict({"transformers": [{"standard": {"columns": ["value"]}}]}, only_listed=True))
    sample = SystematicSample(5, 6, reset_index=True)
    return Preparation(
        [
            Stage((RemoveDuplicates("event_id", ("value", "user_id", "day")),), True),
            Stage((clip, fill)),
            Stage((RowStep("sample", partial(sample.apply, time="ts", row_id="event_id")),), True),
            Stage((TimeFeatures(TimeFeatureSettings("ts")), scale)),
        ]
    )


def _input(spark, sf_dir):
    events = dirty_events(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    return events.select("event_id", "ts", "day", "user_id", "value")


PREPARED = f"""WITH {DIRTY},
d AS (SELECT event_id, ts, user_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY value, user_id, ts::DATE ORDER BY event_id) AS rn FROM dirty)
      WHERE rn = 1),
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM d),
c AS (SELECT event_id, ts, CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1)
             WHEN value > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE value END AS value FROM d, q),
f AS (SELECT event_id, ts, coalesce(value, (SELECT median(value) FROM c)) AS value FROM c),
p AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM f),
s AS (SELECT event_id, ts, value, CAST((pos - 5) / 6 AS BIGINT) AS pos FROM p WHERE pos >= 5 AND (pos - 5) % 6 = 0)"""

RESULT = f"""{PREPARED}
SELECT event_id, pos, round((value - m) / sd, 6) AS value,
       CAST(hour(ts) >= 20 OR hour(ts) <= 5 AS TINYINT) AS is_night,
       (epoch_us(ts) - t0) / 1000000.0::DOUBLE / 86400 AS days_since_start
FROM s, (SELECT avg(value) AS m, stddev_pop(value) AS sd, min(epoch_us(ts)) AS t0 FROM s)"""


@query("prep_stages", RESULT)
def _(spark, sf_dir):
    _, prepared = _preparation().fit_transform(_input(spark, sf_dir))
    return prepared.select(
        "event_id", "pos", r6(F.col("value")).alias("value"), "is_night", "days_since_start",
    )


FITTED = {
    ("01_Outliers", "value"): (
        "d, q",
        {
            "rules.0.threshold": "max(1.5)", "rules.0.mean": "avg(value)", "rules.0.std": "stddev_pop(value)",
            "rules.0.min": "min(value)", "rules.0.max": "max(value)", "rules.0.median": "median(value)",
            "rules.0.lower_bound": "min(q1 - 1.5 * (q3 - q1))",
            "rules.0.upper_bound": "min(q3 + 1.5 * (q3 - q1))",
        },
    ),
    ("02_FillMissing", "event_id"): ("d", {"share": "1 - count(event_id) / count(*)"}),
    ("02_FillMissing", "user_id"): ("d", {"share": "1 - count(user_id) / count(*)"}),
    ("02_FillMissing", "value"): ("c", {"share": "1 - count(value) / count(*)", "value": "median(value)"}),
    ("04_TimeFeatures", "ts"): ("s", {"start": "min(epoch_us(ts))"}),
    ("05_Scale", "value"): (
        "s", {"center": "avg(value)", "factor": "1 / stddev_pop(value)", "shift": "max(0)"},
    ),
}

FITTED_SQL = " UNION ALL ".join(
    f"""SELECT '{step}' AS step, '{column}' AS "column", '{name}' AS name,
        round(CAST({expression} AS DOUBLE), 6) AS number FROM {source}"""
    for (step, column), (source, numbers) in FITTED.items()
    for name, expression in numbers.items()
)


@query("fitted_state", f"{PREPARED} {FITTED_SQL}")
def _(spark, sf_dir):
    """Every fitted number of the run above, saved, read back after the scratch folder is gone, and applied;
    names of methods and formats are left out."""
    saved = f"{shared_folder(spark)}/prepared-{uuid.uuid4().hex}"
    with scratch(spark):
        _preparation().fit(_input(spark, sf_dir)).save(spark, saved)
    state = Prepared.load(spark, saved).fitted_state(spark)
    number = r6(F.expr("try_cast(value as double)"))
    return state.select("step", "column", "name", number.alias("number")).where("number is not null")


@query(
    "train_apply",
    f"""WITH {DIRTY},
        n AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS p, count(*) OVER () AS n FROM dirty),
        l AS (SELECT event_id, value, CASE WHEN p < floor(n * 0.6 + 0.5) THEN 'train'
                WHEN p < floor(n * 0.6 + 0.5) + floor(n * 0.3 + 0.5) THEN 'val' ELSE 'test' END AS split FROM n),
        q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l WHERE split = 'train'),
        c AS (SELECT event_id, split, CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1)
                WHEN value > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE value END AS value FROM l, q),
        f AS (SELECT event_id, split, coalesce(value, (SELECT median(value) FROM c WHERE split = 'train')) AS value FROM c),
        s AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM f WHERE split = 'train')
        SELECT event_id, split, round((value - m) / sd, 6) AS value FROM f, s""",
)
def _(spark, sf_dir):
    events = dirty_events(spark, sf_dir).select("event_id", "ts", "value")
    labelled = TimeSplit().apply(events, "ts", "event_id")
    scale = Scale(ScaleSettings.from_dict({"transformers": [{"standard": {"columns": ["value"]}}]}, only_listed=True))
    steps = Stage(
        (
            Outliers(OutlierSettings((OutlierRule("value", "iqr", "clip", threshold=1.5),))),
            FillMissing(FillSettings({"value": "median"})),
            scale,
        )
    )
    prepared = Preparation([steps]).fit(labelled.where(F.col("split") == "train"))
    return prepared.transform(labelled).select("event_id", "split", r6(F.col("value")).alias("value"))
