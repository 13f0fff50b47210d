"""URL filters: patterns, intervals and the as-of evaluation against a plain replay of the list."""

import random
from datetime import datetime, timedelta
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from millrace.llm import urlfilter

START = datetime(2024, 1, 1)
CAPTURES = "page_id long, url string, fetched_at timestamp, pattern string, captures int"
ENTRIES = "pattern string, category string, action string, at timestamp"


def plain_patterns(url):
    parts = urlsplit(url or "")
    host = (parts.hostname or "").rstrip(".")
    if not host:
        return set()
    labels, steps = host.split("."), [p for p in parts.path.split("/") if p]
    return {
        ".".join(labels[i:]) + "".join("/" + s for s in steps[:n]) for i in range(len(labels)) for n in range(len(steps) + 1)
    }


URLS = [
    "http://a.example.com/x/y?q=1", "https://User@EXAMPLE.com:8080/x//y/#f", "http://b.a.example.com", "ftp://other.org/x", "nonsense", "", None,
    "http://one./", "http://xexample.com/x/yy",
]


def test_patterns(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    for url, found in df.select("url", urlfilter.covering_patterns(F.col("url"))).collect():
        assert set(found) == plain_patterns(url)


def test_intervals(spark):
    day = lambda n: START + timedelta(days=n)
    rows = [
        ("p", "c", "add", day(1)), ("p", "c", "add", day(2)), ("p", "c", "remove", day(3)), ("p", "c", "remove", day(4)), ("p", "c", "add", day(5)),
        ("p", "d", "remove", day(1)), ("q", "c", "add", day(1)), ("q", "c", "remove", day(1)), (None, "c", "add", day(1)), ("r", "c", "add", None),
        ("r", "c", "odd", day(1)), ("p", "c", "add", day(1)),
    ]
    found = urlfilter.intervals(spark.createDataFrame(rows, ENTRIES)).collect()
    assert sorted(map(tuple, found)) == [("p", "c", day(1), day(3)), ("p", "c", day(5), None)] or sorted(
        (r[0], r[2]) for r in found) == [("p", day(1)), ("p", day(5))]


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_captures_match_a_replay(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(urlfilter, "BROADCAST_ROWS", broadcast_rows)
    random.seed(11)
    some = lambda: START + timedelta(hours=random.randint(0, 24 * 200))
    captures = [(i, random.choice(URLS), some() if i % 9 else None, "p", 1) for i in range(150)]
    captures += [captures[1]] * 3 + [(None, URLS[0], START + timedelta(days=50), None, None)]
    patterns = ["example.com", "a.example.com", "example.com/x", "a.example.com/x/y", "org", "other.org/z", "one"]
    entries = [(random.choice(patterns), random.choice("abc"), random.choice(["add", "remove"]), some()) for _ in range(80)]
    found = urlfilter.evaluate(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES))
    for r in found.collect():
        state = {}
        for p, c, action, at in sorted(entries, key=lambda e: (e[3], e[2])):
            if r["fetched_at"] and at <= r["fetched_at"]:
                state[p, c] = action
        active = [k for k, a in state.items() if a == "add" and k[0] in plain_patterns(r["url"])]
        assert r["categories"] == ",".join(sorted({c for _, c in active}))
        assert r["patterns"] == ",".join(sorted({p for p, _ in active}))
        assert r["allowed"] == (not active)
    assert sum(r["captures"] for r in found.collect()) == len(captures) and found.count() == len(captures) - 3


def test_urls_of_very_many_parts(spark):
    """Only as many leading parts are asked for as a listed path has."""
    deep = "http://a.example.com/" + "/".join(f"p{i}" for i in range(20_000))
    listed = "example.com/" + "/".join(f"p{i}" for i in range(30))
    entries = spark.createDataFrame([(listed, "c", "add", START), ("example.com/p0/p2", "d", "add", START)], ENTRIES)
    found = urlfilter.evaluate(spark.createDataFrame([(1, deep, START, "p", 1), (2, URLS[0], START, "p", 1)], CAPTURES), entries)
    assert {r["page_id"]: r["categories"] for r in found.collect()} == {1: "c", 2: ""}
    for r in spark.createDataFrame([(u,) for u in URLS], "url string").select("url", urlfilter.covering_patterns(F.col("url"), 1)).collect():
        assert set(r[1]) == {p for p in plain_patterns(r["url"]) if p.count("/") <= 1}


def test_empty_tables(spark):
    captures, entries = spark.createDataFrame([(1, URLS[0], START, "p", 1)], CAPTURES), spark.createDataFrame([], ENTRIES)
    assert urlfilter.evaluate(captures.limit(0), entries).collect() == []
    assert [r["allowed"] for r in urlfilter.evaluate(captures, entries).collect()] == [True]


def test_sliced_rows_decide_on_the_broadcast(spark, monkeypatch):
    """Old open entries start with the first capture, and many slices of few entries are not broadcast."""
    monkeypatch.setattr(urlfilter, "BROADCAST_ROWS", 20)
    entries = spark.createDataFrame([("example.com", c, "add", START - timedelta(days=7300)) for c in "abc"], ENTRIES)
    hints = []
    monkeypatch.setattr(urlfilter.F, "broadcast", lambda df: hints.append(df.count()) or df)
    one = [(1, URLS[0], START, "p", 1)]
    for captures in (one, one + [(2, URLS[0], START + timedelta(days=600), "p", 1)]):
        found = urlfilter.evaluate(spark.createDataFrame(captures, CAPTURES), entries).collect()
        assert [r["categories"] for r in found] == ["a,b,c"] * len(captures)
    assert hints == [3]
