"""Stateful streams: shuffled micro-batches replayed give what the batch form gives."""

import datetime
import random
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.streaming.series import LateRows, dedup_stream, gap_filled_stream, run_to_table

START = datetime.datetime(2024, 5, 1)
SCHEMA = "who string, ts timestamp, x double"


def rows(n=150):
    """Two series with gaps of hours; 'late' starts later and ends earlier."""
    random.seed(12)
    out, at = [], 0
    for _ in range(n):
        at += random.choice((30, 200, 900, 9_000))
        out.append(("main", START + datetime.timedelta(seconds=at), None if random.random() < 0.1 else random.gauss(5, 2)))
        if n // 4 < len(out) < n // 2:
            out.append(("late", START + datetime.timedelta(seconds=at + 7), 1.0))
    return out


def replay(spark, folder, batches, build, schema=SCHEMA, listener=None):
    """One micro-batch per file, in order."""
    source = folder / uuid.uuid4().hex
    source.mkdir()
    stream = build(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(source)))
    if listener:
        spark.streams.addListener(listener)
    state, out = folder / uuid.uuid4().hex, folder / uuid.uuid4().hex
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(source))
        run_to_table(stream, str(out), str(state))
    return spark.read.schema(stream.schema).parquet(str(out))


def shuffled_batches(rows, lateness, size):
    """Rows arrive up to ``lateness`` seconds late, in files of ``size``."""
    random.seed(13)
    arrival = sorted(rows, key=lambda r: r[1] + datetime.timedelta(seconds=random.uniform(0, lateness)))
    return [arrival[i : i + size] for i in range(0, len(arrival), size)]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def plain_grid(rows, seconds, until, follow):
    """Bucket start -> values, from the first bucket of each series to its last, or to ``until``."""
    out = {}
    for who in {r[0] for r in rows}:
        own = {}
        for w, t, x in rows:
            if w == who:
                own.setdefault(int((t - START).total_seconds()) // seconds, []).append(x)
        last = int((until - START).total_seconds()) // seconds - 1
        for b in range(min(own), (last if follow else min(max(own), last)) + 1):
            values = [x for x in own.get(b, []) if x is not None]
            out[who, START + datetime.timedelta(seconds=b * seconds)] = (round(sum(values), 6), len(values), max(values, default=None))
    return out


@pytest.mark.parametrize("idle", [None, 0])
def test_gaps_are_filled_behind_the_watermark(spark, tmp_path, idle):
    given = rows()
    aggregation = {"x": "sum", "n": "count", "high": "max"}
    batches = shuffled_batches(given, 1500, 40)
    found = replay(
        spark, tmp_path, batches,
        lambda s: gap_filled_stream(s.withColumn("n", F.col("x")).withColumn("high", F.col("x")), "ts", "15min", aggregation, "30 minutes", ["who"], idle))
    mark = max(r[1] for r in given) - datetime.timedelta(minutes=30)
    expected = plain_grid(given, 900, mark, idle is None)
    got = {(r["who"], r["ts"]): (round(r["x"], 6), r["n"], r["high"]) for r in found.collect()}
    assert found.count() == len(got)  # no bucket twice
    assert {k: v for k, v in got.items()} == expected
    assert any(v == (0, 0, None) for v in expected.values())


def test_unknown_settings_are_refused(spark):
    df = spark.createDataFrame([], SCHEMA)
    for freq, how in (("7H", {"x": "sum"}), ("1H", {"x": "median"}), ("1H", {})):
        with pytest.raises(ValueError):
            gap_filled_stream(df, "ts", freq, how, "1 hour")


def test_copies_within_the_horizon_go_and_late_rows_are_counted(spark, tmp_path):
    random.seed(14)
    given = rows(60)
    copies = [random.choice(given) for _ in range(40)] + [(None, given[5][1], None), (None, given[5][1], None)]
    batches = shuffled_batches(given + copies, 1500, 50)
    latest = max(r[1] for b in batches for r in b)
    batches.append([("late", START - datetime.timedelta(days=400), 1.0), ("new", latest, 2.0)])
    listener = LateRows()
    found = replay(spark, tmp_path, batches, lambda s: dedup_stream(s, "ts", "300 days"), listener=listener)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str(r) for r in {*given, *copies, ("new", latest, 2.0)})
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    spark.streams.removeListener(listener)
    assert sum(listener.counts.values()) == 1


def test_columns_that_change_places_are_no_copies(spark, tmp_path):
    given = [("a", START, None), (None, START, 1.0), ("a", START, 1.0), ("a", START, 2.0)]
    found = replay(spark, tmp_path, [given], lambda s: dedup_stream(s, "ts", "1 day"))
    assert found.count() == 4
    by_name = replay(spark, tmp_path, [given], lambda s: dedup_stream(s, "ts", "1 day", ["who"]))
    assert by_name.count() == 2
