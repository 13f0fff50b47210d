"""The scalable primitives against their naive forms, with hot instants, ties and gaps."""

import datetime
import random
import statistics as pystats

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.columns import epoch_micros, number
from millrace.operators.categories import Encode, EncodeSettings, _numbered
from millrace.operators.dedup import dedup_rows
from millrace.operators.splitting import Ratios, ShuffledSplit, TimeSplit
from millrace.operators.windows import WindowSettings, make_windows
from millrace.plans import order
from millrace.plans.counts import modes
from millrace.plans.order import carry_fill, order_buckets, with_position
from millrace.plans.quantiles import quantiles

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    """3,000 rows: a third at one instant, some without a time, values with long gaps."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            ts = START + datetime.timedelta(hours=5)
        elif i % 50 == 1:
            ts = None
        else:
            ts = START + datetime.timedelta(seconds=rng.randrange(86_400))
        value = float(i) if rng.random() < 0.02 else None
        rows.append((rng.randrange(10**6) * 3000 + i, ts, value, None if value is None else f"v{i}"))
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, x double, s string")
    return df.repartition(5).cache()


def naive_position(df):
    return df.withColumn("want", F.row_number().over(Window.orderBy("ts", "id")) - 1)


@pytest.mark.parametrize("buckets", [1, 2, 8, 40])
def test_position_equals_naive_window(hot, buckets):
    got = with_position(hot, "ts", "id", buckets=buckets)
    both = got.join(naive_position(hot).select("id", "want"), "id")
    assert both.count() == 3000
    assert both.where("pos <> want").count() == 0


def test_hot_instant_is_cut_into_pieces(hot):
    sizes = order_buckets(hot, "ts", "id", buckets=30).groupBy(order.BUCKET).count()
    largest = sizes.agg(F.max("count")).first()[0]
    assert largest < 400  # the instant alone holds 1,000 rows
    assert sizes.count() < 90


@pytest.mark.parametrize("buckets", [1, 7, 30])
def test_carry_fill_equals_naive_window(hot, buckets):
    both_ways = hot.withColumns({"y": F.col("x"), "t": F.col("s")})
    got = carry_fill(both_ways, ["x", "s"], ["y", "t"], "ts", "id", buckets=buckets)
    w = Window.orderBy("ts", "id")
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    want = hot.select(
        "id",
        *(F.last(c, ignorenulls=True).over(before).alias(f"before_{c}") for c in "xs"),
        *(F.first(c, ignorenulls=True).over(after).alias(f"after_{c}") for c in "xs"),
    )
    both = got.join(want, "id")
    assert both.count() == 3000
    same = "x <=> before_x and s <=> before_s and y <=> after_x and t <=> after_s"
    assert both.where(f"not ({same})").count() == 0


@pytest.mark.parametrize("chunk_rows", [1, 30, 64, 10_000])
def test_windows_equal_naive_slices(hot, chunk_rows):
    settings = WindowSettings(("x",), ("x",), input_width=3, label_width=2, shift=4)
    got = {
        r["start_pos"]: (r["in_x"], r["out_x"])
        for r in make_windows(hot, settings, "ts", "id", chunk_rows, buckets=9).collect()
    }
    xs = [r["x"] for r in naive_position(hot).orderBy("want").collect()]
    assert got == {i: (xs[i : i + 3], xs[i + 5 : i + 7]) for i in range(len(xs) - 6)}


COLUMNS = {
    "uniform": lambda rng: rng.uniform(-5, 5, 4000),
    "hot_value": lambda rng: np.where(rng.random(4000) < 0.4, 1.25, rng.normal(0, 1, 4000)),
    "wide": lambda rng: 10.0 ** rng.uniform(-150, 150, 4000),
    "one_outlier": lambda rng: np.append(rng.random(3999), 1e300),
    "two_values": lambda rng: rng.integers(0, 2, 4000).astype(float),
    "constant": lambda rng: np.full(4000, 3.5),
    "whole": lambda rng: rng.integers(-1000, 1000, 4000).astype(float),
}


def test_exact_quantiles_by_narrowing(spark):
    rng = np.random.default_rng(3)
    data = {name: make(rng) for name, make in COLUMNS.items()}
    rows = [tuple(float(v[i]) for v in data.values()) for i in range(4000)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(6)
    shares = [0.0, 0.1, 0.25, 0.5, 0.731, 0.9, 1.0]
    wanted = {c: (number(df, c), shares) for c in data}
    narrowed, built_in = quantiles(df, wanted, small=0), quantiles(df, wanted, small=10**9)
    for c, values in data.items():
        expected = np.quantile(values, shares)
        np.testing.assert_allclose(narrowed[c], expected, rtol=1e-12)
        np.testing.assert_allclose(built_in[c], expected, rtol=1e-12)


def test_quantiles_of_empty_and_partly_missing_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (None, 4.0)], "a double, b double")
    wanted = {c: (number(df, c), [0.5]) for c in "ab"}
    assert quantiles(df, wanted, small=0) == {"a": [None], "b": [2.5]}
    assert quantiles(df, wanted) == {"a": [None], "b": [2.5]}


@pytest.mark.parametrize("ratios", [(0.6, 0.3, 0.1), (0.5, 0.0, 0.5), (1.0, 0.0, 0.0), (0.0, 0.2, 0.8)])
def test_time_split_cuts_inside_a_hot_instant(hot, ratios):
    ratios = Ratios(*ratios)
    got = TimeSplit(ratios).apply(hot, "ts", "id").join(naive_position(hot).select("id", "want"), "id")
    train, val, test = ratios.sizes(3000)
    label = F.when(F.col("want") < train, "train").when(F.col("want") < train + val, "val").otherwise("test")
    assert got.where(F.col("split") != label).count() == 0
    assert got.where("split = 'test'").count() == test


def test_shuffled_split_is_exact_and_repeatable(hot):
    split = ShuffledSplit(Ratios(0.5, 0.3, 0.2), seed=5)
    first = {r["id"]: r["split"] for r in split.apply(hot, "id").collect()}
    again = {r["id"]: r["split"] for r in split.apply(hot.repartition(3), "id").collect()}
    other = {r["id"]: r["split"] for r in split.with_params(seed=6).apply(hot, "id").collect()}
    assert first == again != other
    assert sorted(pystats.multimode(first.values())) == ["train"]
    assert [list(first.values()).count(p) for p in ("train", "val", "test")] == [1500, 900, 600]


def test_epoch_micros_does_not_depend_on_the_session_zone(spark, hot):
    utc = hot.select("id", epoch_micros(hot, "ts").alias("a"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        other = {r["id"]: r["b"] for r in hot.select("id", epoch_micros(hot, "ts").alias("b")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r["id"]: r["a"] for r in utc.collect()} == other


def test_numbering_follows_the_alphabet(spark):
    words = sorted({f"w{random.Random(i).randrange(10**6)}" for i in range(500)})
    df = spark.createDataFrame([(w,) for w in words], "value string").repartition(4)
    assert {r["value"]: r["code"] for r in _numbered(df).collect()} == {w: i for i, w in enumerate(words)}


def test_mode_takes_the_smallest_of_equally_frequent_values(spark):
    df = spark.createDataFrame([(2.0, "b"), (10.0, "a"), (10.0, "b"), (2.0, "a"), (None, None)], "n double, t string")
    assert modes(df, ["n"], "double") == {"n": 2.0}
    assert modes(df, ["t"]) == {"t": "a"}


def test_modes_keep_large_whole_numbers(spark):
    large = 2**53 + 1
    df = spark.createDataFrame([(large,), (large,), (large + 1,)], "n long")
    assert modes(df, ["n"], "decimal(20,0)") == {"n": large}


@pytest.mark.parametrize("edge", [float("-inf"), float("inf")])
def test_both_quantile_ways_agree_on_infinities(spark, edge):
    rng = random.Random(3)
    rows = [(rng.gauss(0, 1),) for _ in range(500)] + [(edge,)] * 3
    df = spark.createDataFrame(rows, "x double").repartition(3)
    wanted = {"x": (F.col("x"), [0.0, 0.1, 0.5, 0.9, 0.996, 1.0])}
    assert quantiles(df, wanted, small=0) == quantiles(df, wanted)


@pytest.mark.parametrize("buckets", [1, 8, 40])
def test_positions_at_sentinel_times(spark, buckets):
    """A third at the last instant, some in the year 1 and some without a time, in any number of buckets."""
    last, first = datetime.datetime(9999, 12, 31, 23, 59, 59, 999999), datetime.datetime(1, 1, 1)
    rows = [(i, last if i % 3 == 0 else first if i % 7 == 0 else None if i % 5 == 0 else START) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz").repartition(4)
    both = with_position(df, "ts", "id", buckets=buckets).join(naive_position(df).select("id", "want"), "id")
    assert both.count() == 2000 and both.where("pos <> want").count() == 0
    sizes = order_buckets(df, "ts", "id", buckets=40).groupBy(order.BUCKET).count()
    assert sizes.agg(F.max("count")).first()[0] < 300


def test_dedup_groups_by_hashing(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "a", 3.0)], "id long, t string, x double")
    plan = physical_plan(dedup_rows(df, "id", ["t"]))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_encoding_large_columns_reads_the_source_once(spark, sf_dir):
    columns = ("c_name", "c_back", "c_both")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", F.reverse("c_name").alias("c_back"), F.concat("c_name", "c_mktsegment").alias("c_both"))
    model = Encode(EncodeSettings(columns, driver_limit=10)).fit(customers)
    coded = model.transform(customers)
    assert physical_plan(coded).count("FileScan parquet [c_custkey") == 1
    names = model.decode(coded).exceptAll(customers)
    assert names.count() == 0


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["systematic_sample", "fill_forward", "fill_backward", "make_windows", "split_time_ordered", "dedup_rows"]
)
def test_no_query_moves_rows_to_one_task(spark, sf_dir, name):
    import __spark_entry__ as entry

    plan = physical_plan(entry.queries()[name](spark, sf_dir))
    assert "SinglePartition" not in plan
    assert "Python" not in plan


@pytest.mark.parametrize("name", ["scale_mixed", "handle_clip", "time_features", "split_time_ordered", "outlier_iforest"])
def test_applying_fitted_numbers_is_a_projection(spark, sf_dir, name):
    import __spark_entry__ as entry

    plan = physical_plan(entry.queries()[name](spark, sf_dir))
    assert "Exchange" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
