"""Sources, casts, duplicates, samples, categories, missing values."""

import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions.columns import nan_to_null
from millrace.operators.casting import (
    CastNumeric, CastNumericSettings, OneHot, OneHotSettings, cast_categorical,
)
from millrace.operators.categories import (
    Categories, CategorySettings, Encode, EncodeSettings, boolean_tokens, category_typos, null_tokens,
    similarity,
)
from millrace.operators.dedup import dedup_rows, duplicate_rows
from millrace.operators.missing import FillMissing, FillSettings
from millrace.operators.profiling import drop_useless_columns, identify_column_types
from millrace.operators.sampling import SystematicSample, TimeResample, frequency_seconds
from millrace.operators.splitting import Ratios, ShuffledSplit, TimeSplit
from millrace.session import shared_folder
from millrace.sources.tables import SideOutput, load_tables, require_valid

START = datetime.datetime(2023, 1, 1)


def hours(spark, n, shuffle=False):
    rows = [(START + datetime.timedelta(hours=i), float(i), i) for i in range(n)]
    return spark.createDataFrame(rows[::-1] if shuffle else rows, "ts timestamp_ntz, x double, id long")


def test_load_listed_files_and_a_pattern(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n2,y\n")
    (tmp_path / "new_1.csv").write_text("k,v\n3,z\n")
    (tmp_path / "new_2.csv").write_text("k,v\n4,w\n")
    got = load_tables(spark, ["a.csv"], "new_*.csv", str(tmp_path))
    assert sorted(r["k"] for r in got.collect()) == ["1", "2", "3", "4"]
    with pytest.raises(ValueError):
        load_tables(spark)


def test_a_cluster_has_to_name_the_shared_folder(spark):
    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        def __init__(self, master, conf):
            self.sparkContext, self.conf = Context(master), Conf(conf)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077", {}))
    named = Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_folder(named) == "hdfs:///shared"


def test_guards(spark):
    df = hours(spark, 2)
    assert require_valid(df, ["x"]) is df
    for bad, error in [(None, ValueError), ([1], TypeError), (df.limit(0), ValueError), (df.select(), ValueError)]:
        with pytest.raises(error):
            require_valid(bad)
    with pytest.raises(ValueError, match="absent"):
        require_valid(df, ["absent"])


def test_side_output(spark, tmp_path):
    df = hours(spark, 3)
    assert SideOutput().write(df) is df
    back = SideOutput(True, str(tmp_path), "out.csv").write(df.select("id"))
    assert sorted(r["id"] for r in back.collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        SideOutput(True).write(df)


MIXED = "int_col long, str_numeric_col string, str_mixed_col1 string, whole_and_bad string, `col.dot` string"
MIXED_ROWS = [
    (1, "1", "1", "1", "5"), (2, "2", "2.5", "x", "6"), (3, "3", "abc", "3.0", None), (4, "4", "4", None, "8"),
    (5, "5", "5.5", "4", " 9 "),
]


def test_cast_types_and_values(spark):
    df = spark.createDataFrame(MIXED_ROWS, MIXED)
    names = ["str_numeric_col", "str_mixed_col1", "whole_and_bad", "col.dot", "int_col"]
    got = CastNumeric(CastNumericSettings(names)).fit_transform(df)
    types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    assert types == {
        "int_col": "bigint", "str_numeric_col": "bigint", "str_mixed_col1": "double",
        "whole_and_bad": "bigint", "col.dot": "bigint",
    }
    rows = got.orderBy("int_col").collect()
    assert [r["str_mixed_col1"] for r in rows] == [1.0, 2.5, None, 4.0, 5.5]
    assert [r["whole_and_bad"] for r in rows] == [1, None, 3, None, 4]
    assert [r["col.dot"] for r in rows] == [5, 6, None, 8, 9]


def test_cast_can_avoid_whole_numbers_and_choose_columns_itself(spark):
    df = spark.createDataFrame(MIXED_ROWS, MIXED)
    floats = CastNumeric(CastNumericSettings(["str_numeric_col"], preserve_object_integer_types=False))
    assert floats.fit_transform(df).schema["str_numeric_col"].dataType.simpleString() == "double"
    auto = CastNumeric().fit(df)
    assert set(auto.state) == {"str_numeric_col", "col.dot"}
    assert CastNumeric(CastNumericSettings([])).fit_transform(df).schema == df.schema
    assert CastNumeric(pass_through=True).fit_transform(df).schema == df.schema
    with pytest.warns(UserWarning, match="absent"):
        CastNumeric(CastNumericSettings(["absent"])).fit(df)


def test_cast_keeps_long_integers_and_reads_exponents(spark):
    df = spark.createDataFrame(
        [("9007199254740993", "1.5e10", None), ("-3", "2e3", None)], "big string, sci string, none string"
    )
    got = CastNumeric(CastNumericSettings(["big", "sci", "none"])).fit_transform(df)
    assert [tuple(r) for r in got.collect()] == [(9007199254740993, 15_000_000_000, None), (-3, 2000, None)]
    assert got.schema["none"].dataType.simpleString() == "double"


def test_cast_loses_no_valid_value(spark):
    rows = [("1", "1.1", "1"), ("2", "2.2", "invalid"), ("3", "3.3", "4.5.6"), ("4", "4.4", None), ("5", "5.5", "7")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = CastNumeric(CastNumericSettings(["a", "b", "c"])).fit_transform(df)
    counts = got.agg(*(F.count(c).alias(c) for c in "abc")).first()
    assert tuple(counts) == (5, 5, 2)


def test_one_hot_refuses_too_many_categories(spark):
    df = spark.createDataFrame([(str(i),) for i in range(20)], "c string")
    with pytest.raises(ValueError, match="more than 5"):
        OneHot(OneHotSettings(["c"], max_categories=5)).fit(df)
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    new = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    got = OneHot(OneHotSettings(["c"])).fit(train).transform(new)
    assert [tuple(r) for r in got.collect()] == [(0, 1), (0, 0), (0, 0)]


def test_useless_columns_and_kinds(spark):
    df = hours(spark, 3).withColumns({"one": F.lit("a"), "none": F.lit(None).cast("double"), "t": F.col("id").cast("string")})
    assert drop_useless_columns(df).columns == ["ts", "x", "id", "t"]
    assert identify_column_types(df) == {"numeric": ["x", "id", "none"], "categorical": ["one", "t"], "time": ["ts"]}
    assert cast_categorical(df).columns == df.columns


def test_duplicates(spark):
    rows = [(0, 1, "a", 1), (1, 2, "b", 2), (2, 2, "b", 2), (3, 3, "c", 3), (4, 3, "c", 3), (5, 4, "d", 4)]
    df = spark.createDataFrame(rows, "id long, f1 long, f2 string, y long")
    kept = sorted(tuple(r) for r in dedup_rows(df, "id").collect())
    assert kept == [rows[0], rows[1], rows[3], rows[5]]
    assert sorted(r["id"] for r in duplicate_rows(df, "id").collect()) == [2, 4]
    other_label = df.withColumn("y", F.when(F.col("id") == 2, 9).otherwise(F.col("y")))
    assert dedup_rows(other_label, "id", ["f1", "f2"], label="y").count() == 5
    assert dedup_rows(df.limit(0), "id").count() == 0
    assert dedup_rows(df.limit(1), "id").count() == 1
    assert dedup_rows(df, "id").schema == df.schema


def test_nulls_are_equal_when_removing_duplicates(spark):
    df = spark.createDataFrame([(0, None, 1.0), (1, None, 1.0), (2, "a", None)], "id long, a string, b double")
    assert sorted(r["id"] for r in dedup_rows(df, "id").collect()) == [0, 2]


def test_systematic_sample(spark):
    df = hours(spark, 20, shuffle=True)
    got = SystematicSample(2, 3).apply(df, "ts", "id", buckets=4).orderBy("pos").collect()
    assert [r["id"] for r in got] == [2, 5, 8, 11, 14, 17] == [r["pos"] for r in got]
    got = SystematicSample(1, 2, reset_index=True).apply(hours(spark, 10), "ts", "id").orderBy("pos").collect()
    assert [r["id"] for r in got] == [1, 3, 5, 7, 9]
    assert [r["pos"] for r in got] == [0, 1, 2, 3, 4]
    for bad in ({"start_index": "a"}, {"start_index": 1.5}, {"step": True}):
        with pytest.raises(TypeError):
            SystematicSample(**bad)
    for bad in ({"start_index": -1}, {"step": 0}):
        with pytest.raises(ValueError):
            SystematicSample(**bad)


@pytest.mark.parametrize("freq, rows", [("3H", 8), ("6H", 4), ("4H", 6), ("D", 1), ("30min", 24)])
def test_time_resample_sizes(spark, freq, rows):
    got = TimeResample("ts", freq).apply(hours(spark, 24, shuffle=True)).collect()
    assert len(got) == rows
    assert [r["ts"] for r in got] == sorted(r["ts"] for r in got)


def test_time_resample_values_gaps_and_errors(spark):
    df = hours(spark, 168)
    daily = TimeResample("ts", "D", {"x": "sum"}, label="id", label_aggregation="max").apply(df).collect()
    assert len(daily) == 7 and daily[0]["x"] == sum(range(24)) and daily[0]["id"] == 23
    gaps = df.where("id < 2 or id > 5").limit(4)
    filled = TimeResample("ts", "H", {"x": "sum", "id": "mean"}, keep_empty=True).apply(gaps).collect()
    assert [r["x"] for r in filled][:7] == [0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 6.0]
    assert [r["id"] for r in filled][:7] == [0.0, 1.0, None, None, None, None, 6.0]
    assert TimeResample("absent", "H").apply(df) is df
    assert TimeResample("ts", "2H").apply(df.limit(1)).count() == 1
    for bad in ("", "0H", "3X", "H3", "-2H"):
        with pytest.raises(ValueError):
            frequency_seconds(bad)
    with pytest.raises(ValueError, match="aggregation"):
        TimeResample("ts", "H", "nonsense").apply(df)


def test_buckets_that_do_not_divide_a_day_start_on_the_first_day(spark):
    late = hours(spark, 48).where("id >= 30")
    got = TimeResample("ts", "7H", {"id": "min"}).apply(late).collect()
    assert [r["ts"].hour for r in got] == [0, 7, 14, 21] or got[0]["ts"] == datetime.datetime(2023, 1, 2, 0)
    assert got[0]["ts"] == datetime.datetime(2023, 1, 2, 0)


@pytest.mark.parametrize("n, shares, sizes", [(5, (0.6, 0.2, 0.2), (3, 1, 1)), (4, (0.6, 0.3, 0.1), (2, 1, 1)), (6, (0.5, 0.3, 0.2), (3, 2, 1))])
def test_split_sizes(spark, n, shares, sizes):
    assert Ratios(*shares).sizes(n) == sizes
    got = TimeSplit(Ratios(*shares)).apply(hours(spark, n, shuffle=True), "ts", "id").orderBy("id").collect()
    names = [r["split"] for r in got]
    assert names == ["train"] * sizes[0] + ["val"] * sizes[1] + ["test"] * sizes[2]


def test_split_checks(spark):
    for bad in ((0.5, 0.3, 0.3), (1.2, -0.2, 0.0), ("a", 0.5, 0.5)):
        with pytest.raises(ValueError):
            Ratios(*bad)
    with pytest.raises(ValueError, match="two rows"):
        ShuffledSplit().apply(hours(spark, 1), "id")
    ordered = ShuffledSplit(Ratios(0.5, 0.5, 0.0), shuffle=False).apply(hours(spark, 6), "id")
    assert [r["split"] for r in ordered.orderBy("id").collect()] == ["train"] * 3 + ["val"] * 3
    assert TimeSplit().with_params(train=0.7, val=0.2).ratios == Ratios(0.7, 0.2, 0.1)


def test_tokens(spark):
    texts = ["nan", "NaN", "NULL", "null", "N/A", "n/a", "None", "", " ", "Paris", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    assert [r["c"] for r in null_tokens(df, ["c", "absent"]).collect()] == [None] * 9 + ["Paris", None]
    yes = spark.createDataFrame([(t,) for t in ["Yes", "y", "TRUE", "No", " n ", "False", "maybe"]], "c string")
    assert [r["c"] for r in boolean_tokens(yes, ["c"]).collect()] == ["true"] * 3 + ["false"] * 3 + ["maybe"]


def test_similarity(spark):
    pairs = [("Beijing", "beijing", 1.0), ("Beijing", "Beijin", 6 / 7), ("", "abc", 0.0), ("", "", 1.0), ("ab", "cd", 0.0)]
    df = spark.createDataFrame([(a, b) for a, b, _ in pairs], "a string, b string")
    got = [r["s"] for r in df.select(similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got == pytest.approx([s for *_, s in pairs])


def test_typos_and_rare_values(spark):
    words = ["apple"] * 100 + ["banana"] * 80 + ["appel"] * 1 + ["applle"] + ["zebra"] + ["bananna"] + [None] * 3
    df = spark.createDataFrame([(w,) for w in words], "c string").repartition(4)
    settings = CategorySettings(("c",), rare_threshold=0.05)
    typos = {r["wrong"]: r["correct"] for r in category_typos(df, settings).collect()}
    assert typos == {"applle": "apple", "bananna": "banana"}
    counts = {r["c"]: r["count"] for r in Categories(settings).fit_transform(df).groupBy("c").count().collect()}
    assert counts == {"apple": 101, "banana": 81, "Other": 2, None: 3}
    kept = Categories(CategorySettings(("c",), 0.05, auto_correct_typos=False, consolidate=False)).fit_transform(df)
    assert kept.select("c").distinct().count() == 7


@pytest.mark.parametrize("limit", [2000, 3])
def test_codes(spark, limit):
    words = ["d"] * 50 + ["b", "a", "c", "e"]
    train = spark.createDataFrame([(w,) for w in words], "c string").repartition(3)
    new = spark.createDataFrame([("a",), ("z",), (None,), ("e",), ("d",)], "c string")
    model = Encode(EncodeSettings(("c",), driver_limit=limit)).fit(train)
    coded = model.transform(new.withColumn("word", F.col("c")))
    assert {r["word"]: r["c"] for r in coded.collect()} == {"a": 0, "z": 5, None: 5, "e": 4, "d": 3}
    back = {(r["word"], r["c"]) for r in model.decode(coded).collect()}
    assert back == {("a", "a"), ("z", "__UNKNOWN__"), (None, "__UNKNOWN__"), ("e", "e"), ("d", "d")}
    strict = Encode(EncodeSettings(("c",), handle_unknown="error", driver_limit=limit)).fit(train)
    with pytest.raises(Exception, match="unknown category"):
        strict.transform(new).collect()


def people(spark):
    rows = [
        (25.0, 85.0, 50000.0, "IT"), (None, 90.0, None, "HR"), (30.0, None, None, "IT"),
        (35.0, 78.0, 60000.0, None), (None, 92.0, 55000.0, "Finance"), (40.0, None, 52000.0, "HR"),
    ]
    return spark.createDataFrame(rows, "age double, score double, salary double, department string")


def test_fill_rules(spark):
    config = {
        "spec_fill": [{"constant": {"columns": ["age"], "fill_value": [30]}}, {"median": {"columns": ["salary"]}}],
        "smart_fill_remain": True,
    }
    model = FillMissing(FillSettings.from_dict(config)).fit(people(spark))
    got = model.transform(people(spark))
    assert sum(got.select(*(F.count_if(F.col(c).isNull()).alias(c) for c in got.columns)).first()) == 0
    assert model.state["salary"]["value"] == 53500.0
    assert sorted(r["age"] for r in got.collect())[1:4] == [30.0, 30.0, 30.0]


def test_skipped_columns_keep_their_gaps(spark):
    settings = FillSettings({"age": "mean", "department": "mode"}, skip=("score",), smart=True)
    got = FillMissing(settings).fit_transform(people(spark))
    assert got.where("score is null").count() == 2
    assert got.where("age is null or salary is null or department is null").count() == 0


def test_indicators(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 1.0), (2.0, None, 2.0), (None, None, 3.0), (4.0, None, 4.0), (5.0, 5.0, 5.0), (None, 6.0, 6.0)],
        "important_col double, high_missing_col double, normal_col double",
    )
    settings = FillSettings({c: "mean" for c in df.columns}, important=("important_col", "normal_col"))
    model = FillMissing(settings).fit(df)
    got = model.transform(df)
    assert "important_col_missing_indicator" in got.columns
    assert "high_missing_col_missing_indicator" in got.columns
    assert "normal_col_missing_indicator" not in got.columns
    assert "normal_col" in model.missing_indicator
    assert sum(r["important_col_missing_indicator"] for r in got.collect()) == 2


@pytest.mark.parametrize(
    "settings",
    [{}, {"rules": {"a": "nonsense"}}, {"rules": {"a": "constant"}}, {"rules": {"a": "ffill"}}, {"rules": {"a": "mean"}, "skip": ("a",)}],
)
def test_fill_checks(settings):
    with pytest.raises(ValueError):
        FillSettings(**settings)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "a double")
    assert nan_to_null(df).where("a is null").count() == 2
    assert FillMissing(FillSettings({"a": "mean"})).fit_transform(df).where("a = 1.0").count() == 3
