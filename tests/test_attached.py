"""As-of and interval joins and sessions against plain versions, with hot keys, ties and missing values."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.attach import asof_attach, interval_attach
from millrace.operators.sessions import sessionize, with_sessions

START = datetime.datetime(2024, 1, 1)


def moment(seconds):
    return None if seconds is None else START + datetime.timedelta(seconds=seconds)


def people(n, seed):
    random.seed(seed)
    names = ["hot"] * (n // 3) + [random.choice(["a", "b", "c", None]) for _ in range(n - n // 3)]
    return [(i, w, moment(None if i % 41 == 0 else 5 if i % 5 == 0 else random.randrange(n))) for i, w in enumerate(names)]


ROWS = "id long, who string, at timestamp_ntz"


@pytest.mark.parametrize("parts", [1, 6, 50])
@pytest.mark.parametrize("exact, tolerance", [(True, None), (False, None), (True, 20), (False, 3)])
def test_asof_attach_matches_a_plain_search(spark, parts, exact, tolerance):
    left, right = people(240, 1), people(150, 2)
    df, series = spark.createDataFrame(left, ROWS), spark.createDataFrame([(*r, None if r[0] % 7 == 0 else r[0] * 2) for r in right], ROWS + ", v long")
    found = asof_attach(df, series, "at", ["v", "at"], ["who"], tie="id", tolerance_seconds=tolerance, exact=exact, prefix="s_", parts=parts)
    expected = []
    for i, who, at in left:
        fit = [] if at is None else [r for r in right if r[1] == who and r[2] is not None and (r[2] <= at if exact else r[2] < at)]
        best = max(fit, key=lambda r: (r[2], r[0]), default=None)
        if best and tolerance is not None and (at - best[2]).total_seconds() > tolerance:
            best = None
        expected.append((i, who, at, best and (None if best[0] % 7 == 0 else best[0] * 2), best and best[2]))
    assert found.columns == ["id", "who", "at", "s_v", "s_at"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_asof_attach_without_keys_and_with_empty_sides(spark):
    df, series = spark.createDataFrame(people(30, 3), ROWS), spark.createDataFrame([(1, moment(4)), (2, moment(9))], "v long, t timestamp_ntz")
    found = asof_attach(df, series, "at", ["v"], series_time="t").collect()
    assert all(r["v"] == (None if r["at"] is None or r["at"] < moment(4) else 1 if r["at"] < moment(9) else 2) for r in found) and len(found) == 30
    assert asof_attach(df, series.limit(0), "at", ["v"], series_time="t").where("v is not null").count() == 0
    assert asof_attach(df.limit(0), series, "at", ["v"], series_time="t").count() == 0
    with pytest.raises(ValueError):
        asof_attach(df, series.withColumn("who", F.lit("x")), "at", ["who"], series_time="t")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_attach_matches_a_plain_search(spark, how):
    random.seed(4)
    left = people(200, 5)
    lengths = [0, 1, 2, 30, 200, 5_000, 10**8, -5]
    spans = [(i, random.choice(["hot", "a", "b", None]), s, s + random.choice(lengths)) for i, s in enumerate(random.randrange(-50, 220) for _ in range(60))]
    spans += [(100, "hot", None, 50), (101, "a", 30, None), (102, None, None, None), (103, "zzz", 0, 100)]
    df = spark.createDataFrame(left, ROWS)
    intervals = spark.createDataFrame([(i, w, moment(a), moment(b)) for i, w, a, b in spans], "n long, who string, a timestamp_ntz, b timestamp_ntz")
    found = interval_attach(df, intervals, "at", "a", "b", ["n"], ["who"], how)
    expected = []
    for i, who, at in left:
        second = None if at is None else (at - START).total_seconds()
        hits = [n for n, w, a, b in spans if second is not None and w == who and (a is None or a <= second) and (b is None or second < b)]
        expected += [(i, who, at, n) for n in hits or ([None] if how == "left" else [])]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    assert interval_attach(df, intervals.limit(0), "at", "a", "b", ["n"], ["who"], how).count() == (200 if how == "left" else 0)
    assert interval_attach(df.limit(0), intervals, "at", "a", "b", ["n"], ["who"], how).count() == 0


def test_a_hot_key_meets_its_intervals_in_many_slices(spark):
    """A third of all rows and intervals have one key: rows written by the join stay those of the result."""
    df = spark.range(3_000).select("id", F.lit("k").alias("who"), (F.lit(START) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("at"))
    spans = df.select((F.col("id") * 10).alias("n"), "who", F.col("at").alias("a"), (F.col("at") + F.expr("interval '5' second")).alias("b"))
    assert interval_attach(df, spans, "at", "a", "b", ["n"], ["who"]).count() == 5 * 3_000 - 10


@pytest.mark.parametrize("parts", [1, 5, 60])
def test_sessions_match_a_plain_walk(spark, parts):
    rows = people(300, 6)
    df = spark.createDataFrame([(*r, float(r[0])) for r in rows], ROWS + ", x double")
    expected, last = {}, {}
    for i, who, at in sorted((r for r in rows if r[2]), key=lambda r: (r[2], r[0])):
        before = last.get(who)
        number = 0 if before is None else before[1] + (at - before[0] > datetime.timedelta(seconds=4))
        last[who], expected[i] = (at, number), number
    found = with_sessions(df, "who", "at", "id", 4, parts=parts)
    assert {r["id"]: r["session"] for r in found.collect()} == {i: expected.get(i) for i, _, _ in rows}
    whole = sessionize(df, "who", "at", "id", 4, {"x": "sum"}, {"most": F.max("id")}, parts).collect()
    assert len(whole) == sum(n + 1 for _, n in last.values())
    for r in whole:
        own = [x for x in rows if x[1] == r["who"] and expected.get(x[0]) == r["session"] and x[2]]
        times = [x[2] for x in own]
        assert (r["start"], r["end"], r["n"], r["x"], r["most"]) == (min(times), max(times), len(own), sum(x[0] for x in own), max(x[0] for x in own))
        assert r["seconds"] == (max(times) - min(times)).total_seconds()


def test_sessions_of_nothing(spark):
    none = spark.createDataFrame([], ROWS)
    assert sessionize(none, "who", "at", "id", 4).count() == 0
    with pytest.raises(ValueError):
        with_sessions(none, "who", "at", "id", 0)
    with pytest.raises(ValueError):
        sessionize(none, "who", "at", "id", 4, {"id": "median"})
