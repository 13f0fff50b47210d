"""Series per entity: positions, windows, fits and sweeps against single-series and plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import entities
from millrace.operators.entities import entity_moments, fit_by_entity, sweep_by_entity
from millrace.operators.forecast import SweepConfig, fit_linear, persistence_forecast
from millrace.operators.windows import WindowSettings, make_windows
from millrace.plans.order import with_entity_position

SETTINGS = WindowSettings(("y",), ("y", "x"), input_width=3, label_width=2, shift=2)


def rows(hot: int = 400):
    """One entity holds a third of all rows, one stands at one instant, some rows have no entity or time."""
    random.seed(2)
    names = ["hot"] * hot + ["instant"] * (hot // 4) + [random.choice("abcdefgh") for _ in range(2 * hot - hot // 4)] + [None] * 20
    out = []
    for i, name in enumerate(names):
        time = None if i % 97 == 0 else 5 if name == "instant" else random.randrange(hot)
        out.append((i, name, time, random.gauss(0, 1), None if i % 151 == 0 else random.gauss(3, 2)))
    random.shuffle(out)
    return out


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(rows(), "id long, who string, t long, x double, y double").cache()


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_positions_count_inside_each_entity(df, parts):
    found = {}
    for r in with_entity_position(df, "who", "t", "id", "pos", parts).collect():
        found.setdefault(r["who"], []).append((r["pos"], r["t"] is not None, r["t"] or 0, r["id"]))
    assert len(found) == 11
    for places in found.values():
        places.sort()
        assert [p[0] for p in places] == list(range(len(places)))
        assert [p[1:] for p in places] == sorted(p[1:] for p in places)


def test_a_hot_entity_is_cut_into_many_ranges(df):
    from millrace.plans.order import BUCKET

    placed = with_entity_position(df, "who", "t", "id", "pos", 30)
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert BUCKET in plan  # windows run inside ranges, so that no task sorts a whole entity
    ranges = df.repartitionByRange(30, "who", "t", "id").where("who = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert ranges >= 8


@pytest.mark.parametrize("chunk", [6, 50, 10_000])
def test_windows_equal_those_of_each_series_alone(df, chunk):
    many = make_windows(df, SETTINGS, "t", "id", chunk_rows=chunk, entity="who", buckets=9)
    assert many.columns == ["who", "start_pos", "start_time", "in_y", "in_x", "out_y"]
    for name in ("hot", "instant", "a"):
        alone = make_windows(df.where(F.col("who") == name), SETTINGS, "t", "id").collect()
        own = many.where(F.col("who") == name).drop("who").collect()
        assert sorted(map(str, own)) == sorted(map(str, alone)) and own
    assert many.where("who is null").count() == 20 - SETTINGS.total + 1


def test_a_feature_may_be_the_entity(spark):
    df = spark.createDataFrame([(i, i, i % 2, float(i)) for i in range(20)], "id long, t long, who long, y double")
    windows = make_windows(df, WindowSettings(("y",), ("y", "who"), 2, 1, 1), "t", "id", entity="who")
    assert {tuple(r["in_who"]) for r in windows.where("who = 1").collect()} == {(1.0, 1.0)}


@pytest.mark.parametrize("reg, elastic", [(0.0, 0.0), (0.3, 0.0), (0.1, 1.0)])
def test_fits_equal_those_of_each_series_alone(df, reg, elastic):
    windows = make_windows(df, SETTINGS, "t", "id", entity="who").cache()
    model = fit_by_entity(windows, SETTINGS, "who", reg, elastic)
    for name in ("hot", "a"):
        own = windows.where(F.col("who") == name)
        alone = fit_linear(own, SETTINGS, reg, elastic).weights["y"]
        row = model.table.where(F.col("who") == name).first()
        assert row["n"] == own.where(~F.exists("in_y", lambda v: v.isNull()) & ~F.exists("out_y", lambda v: v.isNull())).count()
        for found, (intercept, weights) in zip(row["weights"], alone, strict=True):
            np.testing.assert_allclose([found["intercept"], *found["w"]], [intercept, *weights], rtol=1e-6, atol=1e-8)
    predicted = model.predict(windows)
    assert predicted.count() == 2 * windows.count()
    assert predicted.columns == ["who", "start_pos", "label", "step", "y_true", "y_pred"]


def test_moments_of_a_hot_entity_are_merged_in_steps(spark, df, monkeypatch):
    monkeypatch.setattr(entities, "MERGED_AT_ONCE", 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        windows = make_windows(df, SETTINGS, "t", "id", entity="who")
        found = entity_moments(windows, SETTINGS, "who").where("entity = 'hot'").first()
        whole = np.array([[*r["in_y"], *r["in_x"], *r["out_y"]] for r in windows.where("who = 'hot'").collect()], dtype=float)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    whole = whole[~np.isnan(whole).any(1)]
    assert found["n"] == len(whole)
    np.testing.assert_allclose(found["mean"], whole.mean(0))
    away = whole - whole.mean(0)
    np.testing.assert_allclose(np.reshape(found["second"], (8, 8)), away.T @ away, atol=1e-9)


def test_sweep_picks_the_best_of_each_entity(df):
    windows = make_windows(df, SETTINGS, "t", "id", entity="who").cache()
    configs = [SweepConfig("plain"), SweepConfig("heavy", 50.0)]
    judged = sweep_by_entity(windows.where("start_pos < 20"), windows.where("start_pos >= 25"), SETTINGS, "who", configs).collect()
    for name in {r["who"] for r in judged}:
        own = {r["config"]: r for r in judged if r["who"] == name}
        best = min(own.values(), key=lambda r: (r["rmse"] if r["rmse"] is not None else 1e9, r["config"]))
        assert len(own) == 2 and [r["config"] for r in own.values() if r["best"]] == ([best["config"]] if best["rmse"] is not None else [])


def test_unknown_entities_and_empty_tables(spark, df):
    windows = make_windows(df, SETTINGS, "t", "id", entity="who")
    model = fit_by_entity(windows.where("who = 'a'"), SETTINGS, "who")
    assert model.predict(windows.where("who = 'b'")).where("y_pred is not null").count() == 0
    none = make_windows(df.limit(0), SETTINGS, "t", "id", entity="who")
    assert none.count() == 0 and fit_by_entity(none, SETTINGS, "who").table.count() == 0
    assert persistence_forecast(none, SETTINGS).count() == 0
