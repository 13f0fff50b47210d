"""Time, wind, selection, scaling, windows, forecasts, metrics, stages, streams."""

import datetime
import math
from functools import partial
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators.base import Apply, load_state, save_state
from millrace.operators.casting import (
    CastNumeric, CastNumericSettings, Sentinel, cast_categorical, fix_sentinels,
)
from millrace.operators.categories import (
    Categories, CategorySettings, Encode, EncodeModel, EncodeSettings, null_tokens,
)
from millrace.operators.dedup import RemoveDuplicates, dedup_rows
from millrace.operators.evaluation import (
    binary_metrics, classification_report, multiclass_metrics, predicted_class, regression_metrics,
)
from millrace.operators.forecast import (
    SweepConfig, fit_linear, forecast_ahead, future_timestamps, model_sweep, persistence_forecast,
)
from millrace.operators.missing import FillMissing, FillSettings
from millrace.operators.outliers import OutlierRule, Outliers, OutlierSettings
from millrace.operators.profiling import DropUseless
from millrace.operators.sampling import SystematicSample
from millrace.operators.scaling import Scale, ScaleModel, Scaler, ScaleSettings, scaling_stats
from millrace.operators.selection import SelectByCorrelation, SelectSettings
from millrace.operators.splitting import Ratios, TimeSplit
from millrace.operators.stages import Preparation, Prepared, RowStep, Stage
from millrace.operators.timefeatures import (
    TimeFeatures, TimeFeatureSettings, detect_time_format, detect_time_types, find_time_column,
    parse_success_rate, spark_pattern, wind_vector,
)
from millrace.operators.windows import WindowSettings, label_matrix, make_windows
from millrace.plans.order import with_position
from millrace.session import scratch
from millrace.sources.tables import SideOutput, load_tables
from millrace.streaming.apply import apply_fitted, resample_stream

START = datetime.datetime(2023, 1, 1)


def hourly(spark, n, start=START):
    rows = [(i, start + datetime.timedelta(hours=i), math.sin(i / 5) + i % 7) for i in range(n)]
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz, x double")


@pytest.mark.parametrize(
    "values, kind",
    [
        ([1577836800, 1577923200, 1578009600, 1578096000, 1578182400], "unix_timestamp"),
        ([43831, 43832, 43833, 43834, 43835], "excel_date"),
        ([1.5, 2.3, 3.1, 4.7, 5.2], "unknown_numeric"),
        ([100, 200, 300, 400, 500], "unknown_numeric"),
        ([1672531200, 1672534800], "unknown_numeric"),
        ([1577836800000 + i * 60000 for i in range(10)], "unix_timestamp"),
    ],
)
def test_time_types(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], f"t {'double' if isinstance(values[0], float) else 'long'}")
    assert detect_time_types(df, ["t"]) == {"t": kind}


def test_order_decides_about_a_numeric_time(spark):
    df = spark.createDataFrame([(i, 1577836800 + (i * 7919 % 50) * 3600) for i in range(50)], "i long, t long")
    assert detect_time_types(df, ["t"])["t"] == "unix_timestamp"
    assert detect_time_types(df, ["t"], order_by="i")["t"] == "unknown_numeric"


def test_finding_the_time_column(spark):
    rows = [(1672531200 + i * 3600, f"2023-01-{i + 1:02d}", 44927.0 + i, 1.0 * i) for i in range(8)]
    df = spark.createDataFrame(rows, "unix long, text string, excel double, value double")
    assert find_time_column(df) == "unix"
    assert find_time_column(df.drop("unix")) == "excel"
    assert find_time_column(df.select("text", "value")) == "text"
    assert find_time_column(df.select("value")) is None
    assert find_time_column(df.withColumn("t", F.lit(START))) == "t"


def test_unix_and_excel_values(spark):
    unix = spark.createDataFrame([(1672531200 + i * 3600,) for i in range(100)], "t long")
    got = TimeFeatures(TimeFeatureSettings("t")).fit_transform(unix)
    assert got.schema["t"].dataType.simpleString() == "timestamp_ntz"
    assert got.agg(F.min("t"), F.count("t")).first()[:] == (START, 100)
    excel = spark.createDataFrame([(44927.5 + i,) for i in range(6)], "t double")
    first = TimeFeatures(TimeFeatureSettings("t")).fit_transform(excel).agg(F.min("t")).first()[0]
    assert first == datetime.datetime(2023, 1, 1, 12)


def test_text_formats(spark):
    df = spark.createDataFrame([("01/15/2023",), ("01/16/2023",), ("01/17/2023",)], "d string")
    assert detect_time_format(df, "d") == ("%m/%d/%Y", 1.0)
    got = TimeFeatures(TimeFeatureSettings("d", "%m/%d/%Y")).fit_transform(df)
    assert got.where("d is null").count() == 0
    bad = spark.createDataFrame([("invalid",), ("also bad",), ("2023-01-01",)], "d string")
    rate = parse_success_rate(bad, "d", "%Y-%m-%d").first()
    assert (rate["n_parsed"], round(rate["success_rate"], 4)) == (1, 0.3333)
    assert spark_pattern("%Y-%m-%dT%H:%M") == "yyyy-MM-dd'T'HH:mm"
    with pytest.raises(ValueError):
        spark_pattern("%Q")


def test_time_features(spark):
    got = TimeFeatures().fit_transform(hourly(spark, 24 * 366, datetime.datetime(2020, 1, 1)))
    assert {"id", "ts", "x"} < set(got.columns)
    assert {r["season"] for r in got.select("season").distinct().collect()} == {"winter", "spring", "summer", "autumn"}
    assert got.schema["is_night"].dataType.simpleString() == "tinyint"
    assert {r["h"] for r in got.where("is_night = 1").select(F.hour("ts").alias("h")).distinct().collect()} == {*range(20, 24), *range(6)}
    for c in ("Day", "Month", "Year"):
        off = F.abs(F.col(f"{c}_sin") ** 2 + F.col(f"{c}_cos") ** 2 - 1)
        assert got.agg(F.max(off)).first()[0] < 1e-10
    last = got.orderBy(F.desc("id")).first()
    assert last["timedelta"] == (24 * 366 - 1) * 3600 and last["days_since_start"] == pytest.approx(366 - 1 / 24)


def test_missing_times_give_missing_features(spark):
    df = spark.createDataFrame([(START,), (None,)], "ts timestamp_ntz")
    row = TimeFeatures().fit_transform(df).where("ts is null").first()
    assert all(v is None for v in row)


def test_wind(spark):
    df = spark.createDataFrame([(d, 10.0) for d in (0, 90, 180, 270, 360)], "wind_dir long, `max. wv` double")
    got = wind_vector(df, ["wind_dir"], ["max. wv", "absent"]).collect()
    pairs = [(round(r["max. wv_x"], 9) + 0.0, round(r["max. wv_y"], 9) + 0.0) for r in got]
    assert pairs == [(10, 0), (0, 10), (-10, 0), (0, -10), (10, 0)]


def test_selection(spark):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(200):
        city = "ABC"[i % 3]
        y = float(rng.normal()) + 5 * (i % 3)
        rows.append((y, 2 * y, float(rng.normal()), city, START + datetime.timedelta(days=i), 1.0))
    df = spark.createDataFrame(rows, "y double, good double, noise double, city string, t timestamp_ntz, same double")
    strict = SelectByCorrelation(SelectSettings("y", 0.9)).fit(df)
    assert strict.transform(df).columns == ["y", "good", "city"]
    assert strict.state["good"]["strength"] == pytest.approx(1.0)
    everything = SelectByCorrelation(SelectSettings("y", 0.0)).fit(df)
    assert everything.transform(df).columns == df.columns
    assert SelectByCorrelation(SelectSettings(None, 0.9)).fit(df).transform(df).columns == df.columns
    unseen = df.withColumn("city", F.lit("elsewhere"))
    assert strict.transform(unseen).count() == 200


def sensors(spark):
    rng = np.random.default_rng(42)
    rows = [
        (i, float(rng.normal(20, 5)), float(rng.exponential(2)), 1.0, None, float(i % 2), float("inf") if i == 0 else float(i))
        for i in range(100)
    ]
    return spark.createDataFrame(
        rows, "id long, temperature double, skewed double, constant double, empty double, flag double, with_inf double"
    )


def test_scaling_methods_and_report(spark):
    df = sensors(spark)
    config = {"transformers": [{"minmax": {"columns": ["temperature"], "feature_range": (-1, 1)}}], "skip_scale": ["id"]}
    model = Scale(ScaleSettings.from_dict(config)).fit(df)
    methods = {c: s["method"] for c, s in model.state.items()}
    assert methods == {
        "id": "user_skip", "temperature": "minmax", "skewed": "robust", "constant": "cons_skip",
        "empty": "standard_skip", "flag": "flag_skip", "with_inf": "standard",
    }
    got = model.transform(df)
    assert got.columns == df.columns
    assert got.agg(F.min("temperature"), F.max("temperature")).first()[:] == pytest.approx((-1, 1))
    assert model.report(spark).where("column = '*'").first()["method"] == "3 of 7 scaled"


def test_scaling_round_trip(spark):
    df = sensors(spark)
    model = Scale(ScaleSettings(skip=("id",))).fit(df)
    back = model.inverse(model.transform(df)).alias("b").join(df.alias("a"), "id")
    for c in ("temperature", "skewed"):
        worst = back.agg(F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) / F.abs(F.col(f"a.{c}")))).first()[0]
        assert worst < 1e-10
    only = model.inverse(model.transform(df), ["skewed"])
    assert only.agg(F.avg("temperature")).first()[0] == pytest.approx(0, abs=1e-9)


@pytest.mark.parametrize("algorithm", ["decision_tree", "random_forest"])
def test_scale_free_algorithms_change_nothing(spark, algorithm):
    df = sensors(spark)
    config = {"transformers": [{"minmax": {"columns": ["temperature"]}}], "skip_scale": ["id"]}
    model = Scale(ScaleSettings.from_dict(config, algorithm=algorithm)).fit(df)
    assert model.state["id"]["method"] == "user_skip"
    assert {s["method"] for c, s in model.state.items() if c != "id"} == {"skip_all"}
    assert model.transform(df).exceptAll(df).count() == 0


@pytest.mark.parametrize(
    "config, message",
    [
        ({"transformers": [{"minmax": {"columns": ["a"], "feature_range": (1, 0)}}]}, "feature_range"),
        ({"transformers": [{"minmax": {"columns": ["a"], "feature_range": ("a", 1)}}]}, "feature_range"),
        ({"transformers": [{"minmax": {"columns": ["a"], "feature_range": (0,)}}]}, "feature_range"),
        ({"transformers": [{"minmax": {"columns": ["a", "b"]}}, {"standard": {"columns": ["a"]}}]}, "more than one"),
        ({"transformers": [{"minmax": {"columns": ["a"]}}], "skip_scale": ["a"]}, "both"),
        ({"skip_scale": ["a", "a"]}, "twice"),
        ({"transformers": [{"nonsense": {"columns": ["a"]}}]}, "unknown scaler"),
    ],
)
def test_scale_checks(config, message):
    with pytest.raises(ValueError, match=message):
        ScaleSettings.from_dict(config)


def test_scaling_stats_and_options(spark):
    rows = {r["column"]: r for r in scaling_stats(sensors(spark), ["constant", "empty", "with_inf"]).collect()}
    assert rows["constant"]["is_constant"] and not rows["with_inf"]["is_constant"]
    assert rows["empty"]["n_samples"] == 0 and rows["with_inf"]["n_samples"] == 99
    df = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    plain = Scale(ScaleSettings({"a": Scaler("standard", with_mean=False, with_std=False)})).fit_transform(df)
    assert sorted(r["a"] for r in plain.collect()) == [1.0, 3.0]
    unlisted = Scale(ScaleSettings({"absent": Scaler("minmax")}, only_listed=True)).fit(df)
    assert unlisted.state == {}


def test_fitted_numbers_survive_saving(spark, tmp_path):
    df = sensors(spark)
    settings = ScaleSettings(skip=("id",))
    model = Scale(settings).fit(df)
    save_state(spark, model, str(tmp_path / "state"))
    again = load_state(spark, ScaleModel, settings, str(tmp_path / "state"))
    assert again.state == model.state
    assert again.transform(df).exceptAll(model.transform(df)).count() == 0


WINDOW = WindowSettings(("x",), ("x",))


def test_windows_and_labels(spark):
    windows = make_windows(hourly(spark, 100), WINDOW, "ts", "id")
    assert windows.count() == 100 - 29
    assert label_matrix(windows, WINDOW).count() == 71 * 5
    assert make_windows(hourly(spark, 29), WINDOW, "ts", "id").count() == 0
    with pytest.raises(ValueError):
        WindowSettings(("x",), ("x",), input_width=0)


def test_linear_forecast_learns_a_line(spark):
    rows = [(i, START + datetime.timedelta(hours=i), 2.0 * i + 1) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, x double")
    windows = make_windows(df, WINDOW, "ts", "id").cache()
    early, late = windows.where("start_pos < 200"), windows.where("start_pos >= 200")
    model = fit_linear(early, WINDOW, reg=1e-6)
    assert regression_metrics(model.predict(late), "y_true", "y_pred").first()["mae"] < 0.1
    result = model_sweep(early, late, WINDOW, [SweepConfig("ok", 1e-6), SweepConfig("bad", -1.0)])
    found = {r["config"]: r for r in result.collect()}
    assert found["ok"]["status"] == "ok" and found["ok"]["mae"] < 0.1
    assert found["bad"]["status"] == "failed" and "regParam" in found["bad"]["error"]


def test_future_times(spark):
    got = [r["ts"] for r in future_timestamps(hourly(spark, 10), "ts", 3600, 5, 24).orderBy("step").collect()]
    assert got == [START + datetime.timedelta(hours=9 + h) for h in range(20, 25)]


def test_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.2), (0, 0.7)], "y int, p double")
    row = binary_metrics(df, "y", "p").first()
    assert (row["tp"], row["fp"], row["tn"], row["fn"], row["accuracy"]) == (1, 1, 1, 1, 0.5)
    probs = spark.createDataFrame([(0, [0.4, 0.4, 0.2]), (2, [0.1, 0.2, 0.7]), (1, [0.9, 0.1, 0.0])], "y int, p array<double>")
    assert [r["c"] for r in probs.select(predicted_class(F.col("p")).alias("c")).collect()] == [0, 2, 0]
    assert multiclass_metrics(probs, "y", "p").first()["correct"] == 2
    report = {r["label"]: r for r in classification_report(probs.withColumn("g", predicted_class(F.col("p"))), "y", "g").collect()}
    assert report["1"]["precision"] == report["1"]["recall"] == report["1"]["f1"] == 0.0
    assert report["0"]["precision"] == 0.5 and report["0"]["recall"] == 1.0
    assert report["accuracy"]["f1"] == pytest.approx(2 / 3)
    assert report["macro avg"]["recall"] == pytest.approx(2 / 3)


def clip_step():
    return Outliers(OutlierSettings((OutlierRule("x", "iqr", "clip", threshold=1.5),)))


def test_stage_checks():
    step = clip_step()
    for bad, error in [
        ({"obj_list": (), "len_change": False}, ValueError),
        ({"obj_list": (Outliers,), "len_change": False}, TypeError),
        ({"obj_list": (step, step), "len_change": False}, ValueError),
        ({"obj_list": (step,), "len_change": True}, TypeError),
        ({"obj_list": (object(),), "len_change": False}, TypeError),
        ({"obj_list": (step,), "len_change": "no"}, TypeError),
    ]:
        with pytest.raises(error):
            Stage(**bad)
    with pytest.raises(ValueError, match="two stages"):
        Preparation([Stage((step,)), Stage((step,))])
    with pytest.raises(ValueError):
        Preparation([])


def test_stages_fit_once_and_apply_anywhere(spark):
    train = hourly(spark, 60).union(hourly(spark, 5).withColumn("id", F.col("id") + 1000))
    fill, scale = FillMissing(FillSettings({"x": "median"})), Scale(ScaleSettings({"x": Scaler("minmax")}, ("id",)))
    steps = RowStep("dedup", partial(dedup_rows, row_id="id"))
    prepared, out = Preparation(
        [{"obj_list": [steps], "len_change": True}, {"obj_list": [clip_step(), fill, scale], "len_change": False}]
    ).fit_transform(train)
    assert out.count() == 60
    again = prepared.transform(train)
    assert again.exceptAll(out).count() == 0
    before = prepared.fitted_state(spark).collect()
    new = hourly(spark, 20).withColumn("x", F.col("x") * 100)
    assert prepared.transform(new).count() == 20
    assert prepared.fitted_state(spark).collect() == before
    assert prepared.attribute("Scale", "state")["x"]["method"] == "minmax"
    with pytest.raises(KeyError):
        prepared.attribute("absent", "state")


def test_spark_ml_pipeline_accepts_the_steps(spark):
    from pyspark.ml import Pipeline

    df = hourly(spark, 50)
    stages = [clip_step(), Scale(ScaleSettings({"x": Scaler("minmax")}, ("id",)))]
    model = Pipeline(stages=stages).fit(df)
    assert model.transform(df).agg(F.min("x"), F.max("x")).first()[:] == pytest.approx((0, 1))


def test_fit_then_transform_equals_fit_transform(spark):
    df = hourly(spark, 50)
    assert clip_step().fit(df).transform(df).exceptAll(clip_step().fit_transform(df)).count() == 0
    assert clip_step().pass_through is False
    assert Outliers(clip_step().settings, pass_through=True).fit_transform(df).schema == df.schema


def test_streams(spark, tmp_path):
    batch = hourly(spark, 48).withColumn("ts", F.col("ts").cast("timestamp"))
    batch.write.parquet(str(tmp_path / "in"))
    model = Scale(ScaleSettings({"x": Scaler("minmax")}, ("id",))).fit(batch)
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    scaled = apply_fitted(stream, [model]).writeStream.format("memory").queryName("scaled").start()
    grid = resample_stream(stream, "ts", "6H", {"x": "mean"}, "1 hour")
    grid = grid.writeStream.format("memory").queryName("grid").outputMode("append").start()
    for running in (scaled, grid):
        running.processAllAvailable()
        running.stop()
    assert spark.table("scaled").exceptAll(model.transform(batch)).count() == 0
    assert spark.table("grid").count() == 7  # the last bucket is still open


def test_no_utc_session_is_needed(spark):
    df = hourly(spark, 30).repartition(4)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert with_position(df, "ts", "id", buckets=3).where("pos <> id").count() == 0
        unix = spark.createDataFrame([(1672531200 + i * 3600,) for i in range(9)], "t long")
        parsed = TimeFeatures(TimeFeatureSettings("t")).fit_transform(unix)
        assert parsed.agg(F.min("t")).first()[0] == START
        last = future_timestamps(df, "ts", 3600, 1, 1).first()["ts"]
        assert last == START + datetime.timedelta(hours=30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def weather_csv(folder, n=600):
    """Ten-minute weather rows with odd column names, gaps, sentinels, text errors and copies."""
    rng = np.random.default_rng(5)
    lines = ["Date Time,T,p,rh,wd,wv,max. wv,sky,station"]
    for i in range(n):
        moment = (START + datetime.timedelta(minutes=10 * i)).strftime("%d.%m.%Y %H:%M:%S")
        wv = -9999.0 if i % 97 == 5 else round(float(rng.uniform(0, 9)), 2)
        p = "" if i % 41 == 3 else f"{1000 + rng.normal(0, 3):.2f}"
        rh = "" if i % 50 == 7 else f"{rng.uniform(30, 90):.1f}"
        t = 500.0 if i == 100 else 10 + 8 * math.sin(i / 23) + rng.normal()
        sky = ["clear", "cloudy", "rain"][i % 3] if i % 200 else "claer"
        sky = "N/A" if i % 61 == 9 else sky
        lines.append(f"{moment},{t:.2f},{p},{rh},{i * 7 % 360},{wv},{wv if wv < 0 else wv + 2},{sky},x")
        if i % 120 == 60:
            lines.append(lines[-1])
    (folder / "weather.csv").write_text("\n".join(lines) + "\n")
    return len(lines) - 1


def test_a_whole_weather_run(spark, tmp_path):
    """Load, split in time order, fit all stages on train, apply to val and test, window, forecast."""
    total = weather_csv(tmp_path)
    raw = load_tables(spark, ["weather.csv"], data_dir=str(tmp_path))
    raw = raw.coalesce(1).withColumn("row", F.monotonically_increasing_id())
    raw = raw.withColumn("when", F.expr("cast(try_to_timestamp(`Date Time`, 'dd.MM.yyyy HH:mm:ss') as timestamp_ntz)"))
    raw = TimeSplit(Ratios(0.6, 0.3, 0.1)).apply(raw, "when", "row").drop("when")
    copies = SideOutput(True, str(tmp_path), "copies.csv")
    numbers = ["T", "p", "rh", "wd", "wv", "max. wv"]
    winds = ["wv", "max. wv"]
    outliers = {
        "detect_and_handle_config": [
            {"zscore": {"columns": ["T"], "handle_method": ["clip"], "threshold": 3}},
            {"iqr": {"columns": ["p"], "handle_method": ["clip"], "threshold": 1.5}},
            {"robust": {"columns": ["rh"], "handle_method": ["clip"], "quantile_range": (5, 95)}},
            {
                "custom": {
                    "columns": winds, "handle_method": ["custom", "custom"],
                    "detect_function": lambda x: x < 0,
                    "handle_function": lambda x, flag, known: F.when(flag, 0.0).otherwise(x),
                }
            },
        ],
        "generate_outlier_indicator": ["T", "p"],
    }
    missing = {
        "spec_fill": [
            {"constant": {"columns": winds, "fill_value": [0.0, 0.0]}},
            {"ffill": {"columns": ["p"]}}, {"bfill": {"columns": ["rh"]}},
        ],
        "smart_fill_remain": True, "important_columns": ["T", "p"],
    }
    scaling = {
        "transformers": [
            {"standard": {"columns": ["T", "p", "wv_x", "wv_y", "max. wv_x", "max. wv_y"]}},
            {"minmax": {"columns": ["rh"], "feature_range": (0, 1)}},
        ],
        "skip_scale": ["is_night", "row", "pos", "Day_sin", "Day_cos", "Month_sin", "Month_cos", "Year_sin", "Year_cos"],
    }
    sample = SystematicSample(5, 6, reset_index=True)
    stages = [
        {"obj_list": [DropUseless(("split",))], "len_change": False},
        {"obj_list": [RemoveDuplicates("row", removed=copies)], "len_change": True},
        {
            "obj_list": [
                Apply("categories", partial(cast_categorical, columns=["sky"])),
                CastNumeric(CastNumericSettings(numbers, exclude_cols=["Date Time"])),
                Apply("null_tokens", partial(null_tokens, columns=["sky"])),
                Apply("sentinels", partial(fix_sentinels, rules={"wd": Sentinel(low=0, high=360)})),
                Outliers(OutlierSettings.from_dict(outliers)),
                Categories(CategorySettings(("sky",), similarity_threshold=0.6)),
                TimeFeatures(TimeFeatureSettings("Date Time")),
                FillMissing(FillSettings.from_dict(missing, time="Date Time", row_id="row")),
            ],
            "len_change": False,
        },
        {"obj_list": [RowStep("sample", partial(sample.apply, time="Date Time", row_id="row"))], "len_change": True},
        {
            "obj_list": [
                Apply("wind", partial(wind_vector, dir_cols=["wd"], var_cols=winds)),
                SelectByCorrelation(SelectSettings("T"), pass_through=True),
                Scale(ScaleSettings.from_dict(scaling, algorithm="lstm")),
                Encode(EncodeSettings(("sky", "season"))),
            ],
            "len_change": False,
        },
    ]
    parts = {s: raw.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}
    prepared, train = Preparation(stages).fit_transform(parts["train"])
    assert "station" not in train.columns and {"T", "p", "max. wv_x", "is_outlier_T", "p_missing_indicator"} <= set(train.columns)
    assert spark.read.csv(str(tmp_path / "copies.csv"), header=True).count() > 0
    sizes = {s: df.count() for s, df in parts.items()}
    assert sum(sizes.values()) == total
    assert train.count() < sizes["train"] / 6
    assert train.agg(F.avg("T")).first()[0] == pytest.approx(0, abs=1e-9)
    assert train.where("sky not in (0, 1, 2)").count() == 0
    assert train.where("T is null or rh is null or wv is null").count() == 0
    val = prepared.transform(parts["val"])
    assert val.columns == train.columns
    settings = WindowSettings(("T", "p"), ("T", "p", "rh"), 6, 5, 10)
    ready = make_windows(train, settings, "Date Time", "row")
    model = fit_linear(ready, settings, reg=0.1)
    forecast = model.predict(make_windows(val, settings, "Date Time", "row"))
    restored = prepared.attribute("Scale", "inverse")(forecast.where("label = 'T'"), {"y_pred": "T", "y_true": "T"})
    found = regression_metrics(restored, "y_true", "y_pred", ["label", "step"]).collect()
    assert len(found) == 5 and all(r["mae"] < 30 for r in found)


def test_a_saved_encoder_outlives_its_scratch_folder(spark, sf_dir, tmp_path):
    settings = EncodeSettings(("c_name",), driver_limit=10)
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    with scratch(spark) as folder:
        model = Encode(settings).fit(customers)
        before = sorted(map(tuple, model.transform(customers).collect()))
        save_state(spark, model, str(tmp_path / "encoder"))
    assert not Path(folder.removeprefix("file:")).exists()
    again = load_state(spark, EncodeModel, settings, str(tmp_path / "encoder"))
    assert sorted(map(tuple, again.transform(customers).collect())) == before


def test_a_saved_preparation_is_complete(spark, tmp_path):
    rows = [(i, START + datetime.timedelta(hours=i), None if i % 5 == 0 else float(i % 7), f"c{i % 30}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, x double, c string")
    fill = FillMissing(FillSettings({"x": "median"}))
    stages = [Stage((fill, Encode(EncodeSettings(("c",), driver_limit=5)))), Stage((RowStep("half", lambda d: d.where("id % 2 = 0")),), True)]
    with scratch(spark):
        prepared, ready = Preparation(stages).fit_transform(df)
        before = sorted(map(tuple, ready.collect()))
        prepared.save(spark, str(tmp_path / "all"))
    with scratch(spark):
        assert sorted(map(tuple, Prepared.load(spark, str(tmp_path / "all")).transform(df).collect())) == before


def test_linear_models_match_closed_forms(spark):
    rng = np.random.default_rng(5)
    series = np.cumsum(rng.normal(size=300))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(series)], "id long, x double")
    one = WindowSettings(("x",), ("x",), input_width=1, label_width=1, shift=1)
    windows = make_windows(df, one, "id", "id")
    x, y = series[:-1], series[1:]
    cov, var = np.mean((x - x.mean()) * (y - y.mean())), x.var()
    wanted = {
        (0.0, 0.0): cov / var, (0.5, 0.0): cov / (1.5 * var),
        (0.2, 1.0): np.sign(cov) * max(abs(cov) / np.sqrt(var) - 0.2, 0) / np.sqrt(var),
    }
    for (reg, elastic), slope in wanted.items():
        intercept, weights = fit_linear(windows, one, reg, elastic).weights["x"][0]
        assert weights[0] == pytest.approx(slope) and intercept == pytest.approx(y.mean() - slope * x.mean())
    wide = WindowSettings(("x",), ("x",), input_width=4, label_width=2, shift=3)
    model = fit_linear(make_windows(df, wide, "id", "id"), wide)
    rows = np.array([series[i : i + 7] for i in range(294)])
    for step in range(2):
        expected = np.linalg.lstsq(np.column_stack([np.ones(294), rows[:, :4]]), rows[:, 5 + step], rcond=None)[0]
        intercept, weights = model.weights["x"][step]
        assert np.allclose([intercept, *weights], expected, atol=1e-8)


def test_forecast_times_follow_the_measured_interval(spark):
    df = hourly(spark, 40)
    settings = WindowSettings(("x",), ("x",), input_width=3, label_width=2, shift=4)
    rows = forecast_ahead(df, settings, "ts", "id", lambda w: persistence_forecast(w, settings)).orderBy("step").collect()
    last = START + datetime.timedelta(hours=39)
    assert [r["ts"] for r in rows] == [last + datetime.timedelta(hours=h) for h in (3, 4)]
    assert {r["y_pred"] for r in rows} == {math.sin(39 / 5) + 39 % 7}
    assert forecast_ahead(df.limit(2), settings, "ts", "id", lambda w: persistence_forecast(w, settings), 3600).count() == 0
