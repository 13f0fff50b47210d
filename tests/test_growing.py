"""Merged summaries and growing preparations against fits over all rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.categories import Categories, CategorySettings
from millrace.operators.mergeable import Summary, fit_summary, mergeable, rank_error, summarize, summary_for
from millrace.operators.missing import FillMissing, FillSettings
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from millrace.operators.scaling import Scale, ScaleSettings
from millrace.operators.stages import Preparation, Prepared, RowStep, Stage

SCHEMA = "part int, a double, b long, c double, word string"


def rows(n=600):
    random.seed(5)
    out = []
    for i in range(n):
        a = None if i % 13 == 0 else math.nan if i % 17 == 0 else random.lognormvariate(0, 1)
        c = math.inf if i == 100 else -math.inf if i == 400 else None if i % 3 == 0 else 7.0
        out.append((i % 4, a, i * i % 91, c, random.choice(["x", "y", "z", None, "rare" if i % 50 == 0 else "x"])))
    return out


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def merged(df):
    """Four parts of unequal size, one of them empty of numbers, merged in another order."""
    parts = [summarize(df.where(F.col("part") == p)) for p in (3, 0, 2, 1)]
    nothing = summarize(df.limit(0))
    return parts[0].merge(nothing.merge(parts[1])).merge(parts[2].merge(parts[3]))


def test_counts_extremes_and_moments_equal_one_pass(df, merged):
    whole = summarize(df)
    assert merged.rows == whole.rows == 600 and set(merged.numbers) == set(whole.numbers) == {"part", "a", "b", "c", "word"}
    for c, own in whole.numbers.items():
        for name in ("present", "plus", "minus", "n", "min", "max", "not_flag"):
            assert merged.numbers[c][name] == own[name], (c, name)
        for name in ("mean", "m2", "m3", "m4"):
            assert merged.numbers[c][name] == pytest.approx(own[name], rel=1e-9, abs=1e-9), (c, name)
    assert sorted(map(tuple, merged.counts(["word"]).collect())) == sorted(map(tuple, whole.counts(["word"]).collect()))


def test_quantiles_are_within_their_error(spark):
    random.seed(1)
    values = [random.paretovariate(1.2) for _ in range(30_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    parts = [summarize(df.where(F.pmod(F.xxhash64("v"), F.lit(5)) == i), sketch_size=200) for i in range(5)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.merge(p)
    shares, ordered = [0.001, 0.1, 0.5, 0.9, 0.999], sorted(values)
    for share, v in zip(shares, merged.quantiles({"v": (None, shares)})["v"], strict=True):
        assert abs(sum(x <= v for x in ordered) / len(ordered) - share) <= 2 * rank_error(200)
    assert summarize(df.limit(0)).quantiles({"v": (None, [0.5])}) == {"v": [None]}


STEPS = [
    (Scale(ScaleSettings.from_dict({"transformers": [{"minmax": {"columns": ["b"]}}, {"standard": {"columns": ["a"]}}]})), ["a", "b", "part", "c"]),
    (FillMissing(FillSettings({"a": "mean", "b": "mode", "word": "mode", "c": "mean"}, important=("a",))), ["a", "b", "c", "word"]),
    (Outliers(OutlierSettings((OutlierRule("a", "zscore", "clip", threshold=2.0), OutlierRule("c", "iqr", "nan", threshold=1.5)))), ["a", "c"]),
    (Categories(CategorySettings(("word",), rare_threshold=0.1)), ["word"]),
]


@pytest.mark.parametrize("step, columns", STEPS)
def test_steps_learn_the_same_from_merged_summaries(df, step, columns):
    assert mergeable(step)
    parts = [summary_for(step, df.where(F.col("part") == p)) for p in range(4)]
    merged = parts[0].merge(parts[1]).merge(parts[2]).merge(parts[3])
    found, whole = fit_summary(step, merged).state, step.fit(df).state

    def same(a, b):
        if isinstance(a, dict):
            return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
        if isinstance(a, list):
            return len(a) == len(b) and all(same(x, y) for x, y in zip(a, b, strict=True))
        if isinstance(a, float) and isinstance(b, float):
            return a == b or math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=0.02 if step in (STEPS[0][0], STEPS[2][0]) else 1e-9, abs_tol=1e-9)
        return a == b

    for c in columns:
        assert same(found[c], whole[c]), (c, found[c], whole[c])


def test_rules_that_need_rows_are_refused(df):
    step = Outliers(OutlierSettings((OutlierRule("a", "mad", "nan"),)))
    assert not mergeable(step)
    with pytest.raises(ValueError):
        step.learn(df.limit(0), summarize(df))


def test_summaries_can_be_saved_and_differing_ones_not_merged(spark, merged, tmp_path):
    merged.save(str(tmp_path / "s"))
    back = Summary.load(spark, str(tmp_path / "s"))
    assert back.numbers == merged.numbers and back.rows == merged.rows and back.schema == merged.schema
    assert back.merge(merged).rows == 1200
    with pytest.raises(ValueError):
        merged.merge(summarize(spark.createDataFrame([(1,)], "other int")))


def preparation():
    clip = Outliers(OutlierSettings((OutlierRule("a", "zscore", "nan", threshold=2.0),)))
    mad = Outliers(OutlierSettings((OutlierRule("b", "mad", "nan"),)))
    scale = Scale(ScaleSettings.from_dict({"transformers": [{"minmax": {"columns": ["b"]}}]}, only_listed=True))
    return Preparation([Stage((RowStep("some", lambda t: t.where("part < 3")),), True), Stage((clip, mad)), Stage((scale,))])


def test_an_extended_preparation_has_seen_all_rows(spark, df, tmp_path):
    old, new = df.where("b % 2 = 0"), df.where("b % 2 = 1")
    first, _ = preparation().fit_transform(old, growing=True)
    first.save(spark, str(tmp_path / "p"))
    grown, out = Prepared.load(spark, str(tmp_path / "p")).extend(new)
    whole = preparation().fit(df)
    a, b = (p.attribute("01_Outliers", "state")["a"]["rules"][0] for p in (grown, whole))
    assert a["mean"] == pytest.approx(b["mean"]) and a["std"] == pytest.approx(b["std"])
    assert out.count() == new.where("part < 3").count()
    assert grown.attribute("02_Outliers", "state") == first.attribute("02_Outliers", "state")  # needs rows: stays as it was
    twice, _ = grown.extend(new.limit(0))
    assert twice.attribute("01_Outliers", "state") == grown.attribute("01_Outliers", "state")


def test_one_step_can_be_fitted_again(df):
    prepared = preparation().fit(df)
    again = prepared.refit("03_Scale", df.where("part = 0"))
    for name in ("01_Outliers", "02_Outliers"):
        assert again.attribute(name, "state") == prepared.attribute(name, "state")
    alone = prepared.steps[2][1].transform(prepared.steps[1][1].transform(df.where("part = 0")))
    assert again.attribute("03_Scale", "state") == preparation().stages[2].obj_list[0].fit(alone).state
    with pytest.raises(ValueError):
        prepared.refit("some", df)
    with pytest.raises(KeyError):
        prepared.refit("none", df)
