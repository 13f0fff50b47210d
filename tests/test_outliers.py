"""Numeric outliers: pinned fixtures, settings checks, properties."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators.outlier_profile import (
    OutlierProfile, ProfileSettings, SmartOutliers, SmartSettings, choose_method, distribution_stats,
    normality_p,
)
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from millrace.plans.isolation import anomaly_steps, average_path


def column(spark, values, name="values"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, `{name}` double")


def fitted(df, **rule):
    return Outliers(OutlierSettings((OutlierRule("values", **rule),))).fit(df)


def values_of(df, name="values"):
    return [r[name] for r in df.orderBy("id").collect()]


SIX = [1.0, 2.0, 3.0, 100.0, 4.0, 5.0]


@pytest.mark.parametrize(
    "options, expected",
    [
        ({"handle": "nan"}, None),
        ({"handle": "impute"}, 3.5),
        ({"handle": "constant", "constant_value": 999}, 999.0),
        (
            {"handle": "custom", "handle_function": lambda x, flag, known: F.when(flag, F.lit(known["mean"])).otherwise(x)},
            115 / 6,
        ),
    ],
)
def test_handling(spark, options, expected):
    df = column(spark, SIX)
    got = values_of(fitted(df, method="zscore", threshold=2, **options).transform(df))
    assert got[:3] + got[4:] == SIX[:3] + SIX[4:]
    assert got[3] == expected if expected is None else math.isclose(got[3], expected)


def test_impute_on_whole_numbers(spark):
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(SIX)], "id long, values long")
    model = fitted(df, method="zscore", threshold=2, handle="impute")
    assert values_of(model.transform(df))[3] == 3.5


def test_clip_stays_in_range_and_shrinks_the_spread(spark):
    df = column(spark, [1.0, 2.0, 3.0, 100.0, -100.0, 4.0, 5.0])
    got = values_of(fitted(df, method="iqr", threshold=1.5, handle="clip").transform(df))
    assert max(got) < 100 and min(got) > -100
    rng = np.random.default_rng(0)
    noisy = [*rng.normal(0, 1, 90), 100.0, -100.0, 150.0, -150.0]
    df = column(spark, [float(v) for v in noisy])
    clipped = values_of(fitted(df, method="iqr", threshold=1.5, handle="clip").transform(df))
    assert np.std(clipped) < np.std(noisy)
    assert np.ptp(clipped) < np.ptp(noisy)


def test_percentile_bounds_find_planted_extremes(spark):
    rng = np.random.default_rng(1)
    df = column(spark, [*map(float, rng.normal(0, 1, 95)), 10.0, -10.0, 15.0, -15.0, 20.0])
    marked = fitted(df, method="robust", quantile_range=(25, 75)).mark(df)
    assert marked.where("id >= 95 and is_outlier_values").count() == 5


def test_constant_single_and_empty_columns_need_nothing(spark):
    df = spark.createDataFrame(
        [(i, 5.0, None, float(i)) for i in range(10)], "id long, c double, e double, x double"
    )
    rules = tuple(
        OutlierRule(c, m, "clip", threshold=1.5) for c in ("c", "e") for m in ("zscore", "iqr", "mad", "robust")
    )
    model = Outliers(OutlierSettings(rules)).fit(df)
    for c in ("c", "e"):
        assert {s["detect_method"] for s in model.state[c]["rules"]} == {"no_need"}
    assert model.transform(df).where("c <> 5 or e is not null").count() == 0


def test_unknown_column_only_warns(spark):
    df = column(spark, SIX)
    rules = (OutlierRule("absent", "iqr", threshold=1.5), OutlierRule("values", "iqr", threshold=1.5))
    with pytest.warns(UserWarning, match="absent"):
        model = Outliers(OutlierSettings(rules)).fit(df)
    assert model.transform(df).count() == 6


def test_thresholds_come_from_training_only(spark):
    train, new = column(spark, [1.0, 2.0, 3.0, 4.0, 5.0]), column(spark, [3.0, 1000.0])
    model = fitted(train, method="iqr", threshold=1.5, handle="clip")
    before = dict(model.state)
    assert values_of(model.transform(new)) == [3.0, 7.0]
    assert model.state == before


def test_nan_counts_as_missing(spark):
    df = column(spark, [1.0, 2.0, float("nan"), 3.0, 4.0, 90.0])
    model = fitted(df, method="iqr", threshold=1.5)
    assert values_of(model.mark(df), "is_outlier_values") == [False] * 5 + [True]


def test_first_rule_repairs_and_all_rules_mark_the_row(spark):
    df = column(spark, SIX)
    rules = (
        OutlierRule("values", "zscore", "nan", threshold=2),
        OutlierRule("values", "minmax_business", "clip", feature_range_business=(2, 4)),
    )
    model = Outliers(OutlierSettings(rules)).fit(df)
    assert values_of(model.transform(df)) == [1.0, 2.0, 3.0, None, 4.0, 5.0]
    assert [r["id"] for r in model.keep_normal(df).orderBy("id").collect()] == [1, 2, 4]


@pytest.mark.parametrize(
    "rule, message",
    [
        ({"method": "nonsense"}, "unknown detection"),
        ({"method": "zscore"}, "threshold"),
        ({"method": "iqr"}, "threshold"),
        ({"method": "custom"}, "detect_function"),
        ({"method": "minmax_business", "feature_range_business": (100, 0)}, "ordered pair"),
        ({"method": "minmax_business"}, "ordered pair"),
        ({"method": "mad", "handle": "nonsense"}, "unknown handling"),
        ({"method": "mad", "handle": "custom"}, "handle_function"),
        ({"method": "mad", "handle": "constant"}, "constant_value"),
    ],
)
def test_rule_checks(rule, message):
    with pytest.raises(ValueError, match=message):
        OutlierRule("T", **rule)


def test_dictionary_settings():
    config = {
        "detect_and_handle_config": [
            {"zscore": {"columns": ["a", "b"], "handle_method": ["clip", "nan"], "threshold": 3}},
            {"robust": {"columns": ["c"], "handle_method": ["clip"], "quantile_range": (5, 95)}},
        ],
        "generate_outlier_indicator": ["a"],
    }
    settings = OutlierSettings.from_dict(config)
    assert [(r.column, r.method, r.handle) for r in settings.rules] == [
        ("a", "zscore", "clip"), ("b", "zscore", "nan"), ("c", "robust", "clip"),
    ]
    assert settings.indicators == ("a",)
    with pytest.raises(ValueError, match="required"):
        OutlierSettings.from_dict({"detect_and_handle_config": [{"mad": {"columns": ["a"]}}]})


def test_isolation_forest_flags_planted_extremes(spark):
    rng = np.random.default_rng(4)
    values = [*map(float, rng.normal(0, 1, 4950)), *map(float, rng.uniform(30, 90, 50))]
    df = column(spark, values).repartition(5)
    rule = OutlierRule("values", "isolationforest", "clip", contamination=0.02, random_state=42)
    model = Outliers(OutlierSettings((rule,), row_id="id")).fit(df)
    marked = model.mark(df)
    flagged = marked.where("is_outlier_values").count()
    assert 0.01 * 5000 <= flagged <= 0.0205 * 5000
    assert marked.where("id >= 4950 and is_outlier_values").count() >= 48
    assert max(values_of(model.transform(df))) < 30
    again = Outliers(OutlierSettings((rule,), row_id="id")).fit(df.repartition(3))
    rules = [m.state["values"]["rules"][0] for m in (model, again)]
    assert rules[0]["ranges"] == rules[1]["ranges"]


def test_forest_scores_rise_towards_the_edges():
    edges, scores = anomaly_steps(np.sort(np.random.default_rng(0).normal(0, 1, 2000)), 1)
    middle = scores[np.searchsorted(edges, 0.0) - 1]
    assert scores[0] > middle and scores[-1] > middle
    assert average_path(2) == 1.0 and average_path(1) == 0.0


def test_profile_of_short_and_constant_columns(spark):
    rows = [(i, float(i % 10), 7.0, float(i) if i < 3 else None) for i in range(100)]
    rows[50] = (50, 500.0, 7.0, None)
    df = spark.createDataFrame(rows, "id long, normal double, constant double, short double")
    columns = ("normal", "constant", "short")
    model = OutlierProfile(ProfileSettings("iqr", 1.5, columns)).fit(df)
    assert set(model.state) == {"normal", "constant"}
    assert [r["id"] for r in model.transform(df).where("is_outliers").collect()] == [50]
    unknown = OutlierProfile(ProfileSettings("nonsense", 99, columns)).fit(df)
    assert unknown.state == model.state
    zscore = OutlierProfile(ProfileSettings("zscore", 3, columns)).fit(df)
    assert set(zscore.state) == {"normal", "constant", "short"}
    assert [r["id"] for r in zscore.transform(df).where("is_outliers").collect()] == [50]
    assert [tuple(r) for r in zscore.info(df).collect()] == [("normal", "zscore", 1, 3.0)]


def test_distribution_of_few_values_is_open(spark):
    row = distribution_stats(column(spark, [1.0, 2.0, 3.0]), ["values"]).first()
    assert row["n_samples"] == 3 and row["skewness"] is None and row["is_normal"] is None
    assert choose_method({"n_samples": 3}, "mad") == ("iqr", "too few values")


def test_normality_rejects_exponential_and_accepts_normal_samples():
    rng = np.random.default_rng(11)

    def p(x):
        d = x - x.mean()
        m2 = (d**2).mean()
        return normality_p(len(x), (d**3).mean() / m2**1.5, (d**4).mean() / m2**2 - 3)

    assert p(rng.exponential(1, 500)) < 1e-6
    rejected = sum(p(rng.normal(0, 1, 200)) < 0.05 for _ in range(1000))
    assert 25 <= rejected <= 90
    assert normality_p(15, 0.0, 0.0) == 0.0


def test_smart_choice_can_be_switched_off(spark):
    rng = random.Random(2)
    df = column(spark, [rng.expovariate(1) for _ in range(300)])
    assert SmartOutliers(SmartSettings(("values",))).fit(df).settings.rules[0].method == "iqr"
    chosen = SmartOutliers(SmartSettings(("values",), default_method="mad", auto_select=False)).fit(df)
    assert chosen.settings.rules[0].method == "mad"
    assert chosen.reasons["values"] == "chosen by the user"
