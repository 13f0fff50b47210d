"""Times written in several ways in one column."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.mixedtimes import MixedTimeSettings, ParseMixedTimes, family, learn_orders, parse_time_mixed, shape, time_shapes

at = datetime.datetime

CASES = [
    ("2024-03-05", at(2024, 3, 5)), (" 2024-3-5 ", at(2024, 3, 5)), ("2024/03/05 06:07", at(2024, 3, 5, 6, 7)), ("2024.03.05 06:07:08", at(2024, 3, 5, 6, 7, 8)),
    ("2024-03-05T06:07:08.25", at(2024, 3, 5, 6, 7, 8, 250_000)), ("2024-03-05T06:07:08Z", at(2024, 3, 5, 6, 7, 8)),
    ("2024-03-05 06:07:08+02:30", at(2024, 3, 5, 3, 37, 8)), ("2024-03-05 06:07:08 -0100", at(2024, 3, 5, 7, 7, 8)),
    ("2024-03-05 06:07:08.123456789", at(2024, 3, 5, 6, 7, 8, 123456)), ("20240305", at(2024, 3, 5)), ("20240305T0607", at(2024, 3, 5, 6, 7)),
    ("20240305060708", at(2024, 3, 5, 6, 7, 8)), ("5 Mar 2024", at(2024, 3, 5)), ("05-MARCH-2024 11:12 PM", at(2024, 3, 5, 23, 12)),
    ("Mar 5, 2024 12:00 am", at(2024, 3, 5)), ("March 5 2024 12:30 p.m.", at(2024, 3, 5, 12, 30)), ("1709618828", at(2024, 3, 5, 6, 7, 8)),
    ("1709618828123", at(2024, 3, 5, 6, 7, 8, 123_000)), ("1709618828123456", at(2024, 3, 5, 6, 7, 8, 123456)), ("-1709618828", at(1915, 10, 29, 17, 52, 52)),
    ("2024-02-30", None), ("2024-13-01", None), ("5 Mrz 2024", None), ("2024-03-05 25:00", None), ("2024-03-05 13:00 PM", None), ("soon", None), ("", None),
    (None, None), ("12345", None), ("2024-03/05", None), ("٢٠٢٤-٠٣-٠٥", None), ("1" * 50_000, None),
]


def test_single_forms(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, t string")
    found = {r["id"]: r["t"] for r in parse_time_mixed(df, "t").collect()}
    assert {CASES[i][0]: v for i, v in found.items()} == dict(CASES)


def test_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id int, t string")
        texts = parse_time_mixed(df, "t").select("id", F.col("t").cast("string").alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    wanted = {i: None if v is None else str(v).rstrip("0").rstrip(".") if v.microsecond else str(v) for i, (_, v) in enumerate(CASES)}
    assert {r["id"]: r["t"] for r in texts} == wanted


@pytest.mark.parametrize("day_first", [True, False])
def test_the_column_settles_day_and_month(spark, day_first):
    """A single value with a day over 12 decides for all of its separator, then for the others."""
    other = "%d/%m/%Y" if day_first else "%m/%d/%Y"
    days = [at(2023, 1 + i % 12, 1 + i % 12) + datetime.timedelta(days=i % 3) for i in range(40)] + [at(2023, 5, 25)]
    rows = [(i, d.strftime(other), d) for i, d in enumerate(days)] + [(100 + i, d.strftime(other.replace("/", "-")), d) for i, d in enumerate(days[:5])]
    df = spark.createDataFrame(rows, "id int, t string, wanted timestamp_ntz")
    assert parse_time_mixed(df, "t").where("t <> wanted or t is null").count() == 0


def test_separators_are_settled_apart_and_no_value_is_lost(spark):
    rows = [("25.12.2023", at(2023, 12, 25)), ("01.02.2023", at(2023, 2, 1)), ("12/25/2023", at(2023, 12, 25)), ("01/02/2023", at(2023, 1, 2)),
            ("12/26/2023", at(2023, 12, 26)), ("27/12/2023", at(2023, 12, 27)), ("31-12-99", at(1999, 12, 31)), ("68-01-02", at(2068, 1, 2))]
    df = spark.createDataFrame(rows, "t string, wanted timestamp_ntz")
    orders = learn_orders(df, "t")
    assert orders["year_last ."][0] == "dmy" and orders["year_last /"][0] == "mdy"
    assert parse_time_mixed(df, "t").where("t <> wanted or t is null").count() == 0


def test_what_was_learned_is_applied_to_new_rows(spark):
    step = ParseMixedTimes(MixedTimeSettings(("t", "absent")))
    model = step.fit(spark.createDataFrame([("25/12/2023",), ("01/02/2023",)], "t string"))
    new = spark.createDataFrame([("03/04/2023",), ("12/31/2023",), ("2023-04-03 10:00",), (None,)], "t string")
    assert [r["t"] for r in model.transform(new).collect()] == [at(2023, 4, 3), at(2023, 12, 31), at(2023, 4, 3, 10), None]


def test_shapes_and_families(spark):
    random.seed(3)
    rows = [("2024-01-%02d" % random.randrange(1, 29),) for _ in range(30)] + [("1 May 2024 9:05 AM",), ("??",), (None,)]
    found = {r["shape"]: r for r in time_shapes(spark.createDataFrame(rows, "t string"), "t").collect()}
    assert set(found) == {"9999-99-99", "9 A 9999 9:99 A", "??"}
    assert found["9999-99-99"]["n"] == found["9999-99-99"]["n_parsed"] == 30 and found["??"]["n_parsed"] == 0
    one = spark.createDataFrame([("05/06/07",)], "t string").select(family(F.col("t")), shape(F.col("t"))).first()
    assert tuple(one) == ("short_year", "99/99/99")
    assert time_shapes(spark.createDataFrame([], "t string"), "t").count() == 0
