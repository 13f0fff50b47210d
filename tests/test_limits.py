"""Time ceilings for fitting and applying, on tables of the sizes the ceilings were set for."""

import time

import pytest
from pyspark.sql import functions as F

from millrace.operators.casting import CastNumeric, CastNumericSettings
from millrace.operators.dedup import dedup_rows
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from millrace.operators.sampling import SystematicSample
from millrace.operators.scaling import Scale, Scaler, ScaleSettings
from millrace.operators.timefeatures import TimeFeatures, TimeFeatureSettings


def numbers(spark, rows, columns, kind="double"):
    made = [(F.randn(seed=i) * 10).cast(kind).alias(f"c{i}") for i in range(columns)]
    return spark.range(rows).select("id", F.expr("timestamp_ntz'2010-01-01' + make_interval(0, 0, 0, 0, id)").alias("ts"), *made)


def sampling(spark):
    return SystematicSample(0, 10).apply(numbers(spark, 10_000, 3), "ts", "id")


def casting(spark):
    return CastNumeric(CastNumericSettings([f"c{i}" for i in range(5)])).fit_transform(numbers(spark, 10_000, 5, "string"))


def scaling(spark):
    return Scale(ScaleSettings(skip=("id",))).fit_transform(numbers(spark, 10_000, 50))


def clipping(spark):
    rules = tuple(OutlierRule(f"c{i}", "zscore", "clip", threshold=3) for i in range(3))
    return Outliers(OutlierSettings(rules)).fit_transform(numbers(spark, 10_000, 3))


def time_features(spark):
    return TimeFeatures(TimeFeatureSettings("ts")).fit_transform(numbers(spark, 87_600, 1))


def duplicates(spark):
    table = numbers(spark, 10_000, 0).select("id", (F.col("id") % 5000).alias("f1"), (F.col("id") % 100).alias("f2"), F.lit(1).alias("y"))
    return dedup_rows(table, "id", ["f1", "f2"], label="y")


@pytest.mark.parametrize(
    "run, limit", [(sampling, 5), (casting, 10), (scaling, 30), (clipping, 10), (time_features, 30), (duplicates, 10)]
)
def test_ceiling(spark, run, limit):
    run(spark).write.format("noop").mode("overwrite").save()
    start = time.perf_counter()
    run(spark).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - start
    print(f"{run.__name__}: {took:.2f} s, ceiling {limit} s")
    assert took < limit


def test_many_columns_by_narrowing(spark):
    from millrace.plans import quantiles as plans

    table = numbers(spark, 20_000, 40).drop("ts")
    scalers = {f"c{i}": Scaler("robust") for i in range(40)}
    built_in = Scale(ScaleSettings(scalers, only_listed=True))
    start = time.perf_counter()
    got = plans.quantiles(table, {c: (F.col(c), [0.25, 0.5, 0.75]) for c in scalers}, small=0)
    print(f"narrowing 40 columns: {time.perf_counter() - start:.2f} s")
    state = built_in.fit(table).state
    for c in scalers:
        assert state[c]["center"] == pytest.approx(got[c][1], rel=1e-12)
        assert 1 / state[c]["factor"] == pytest.approx(got[c][2] - got[c][0], rel=1e-12)
