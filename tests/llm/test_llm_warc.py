"""Revisit resolution against a plain search of earlier responses."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.llm import asof, warc

START = datetime(2024, 1, 1)
SCHEMA = "page_id long, url string, fetched_at timestamp, status int, headers map<string,string>, key string, value int"

CANONICAL = {
    "HTTP://WWW.Example.com:80/a/?b=2&a=1&utm_x=3&ref=z#top": "example.com/a?a=1&b=2",
    "https://user@example.com/a": "example.com/a", "http://www2.example.com": "example.com", "http://example.com./?": "example.com",
    "example.com/A/": "example.com/A", "": "", None: None, "http://e.org/p?REF=1&&x": "e.org/p?x",
}


def test_canonical_urls(spark):
    df = spark.createDataFrame([(u,) for u in CANONICAL], "url string")
    assert dict(df.select("url", warc.canonical_url(F.col("url"))).collect()) == CANONICAL


def test_headers(spark):
    row = spark.createDataFrame(
        [({"ETag": "a", "etag ": "b", "X": None, "Content-Length": "9", "Keep": "1"}, {"etag": "c", "content-length": "0", "new": "2"})],
        "stored map<string,string>, update map<string,string>")
    stored = warc.lower_names(F.col("stored"))
    merged = row.select(warc.merged_headers(stored, F.col("update")), warc.lower_names(F.lit(None).cast("map<string,string>"))).first()
    assert merged[0] == {"etag": "c", "content-length": "9", "keep": "1", "new": "2"} and merged[1] == {}


@pytest.mark.parametrize("seconds", [1, 3600, 10**9])
def test_latest_earlier(spark, seconds):
    random.seed(seconds)
    moment = lambda: START + timedelta(seconds=random.randint(0, 4000))
    events = [(random.choice(["hot", "hot", "cold", None]), moment(), random.randint(0, 99)) for _ in range(400)] + [("hot", None, 1)]
    asks = [(random.choice(["hot", "cold", "other", None]), moment()) for _ in range(300)] + [("hot", None), ("hot", START)]
    found = asof.latest_earlier(
        spark.createDataFrame(events, "key string, time timestamp, value int"), spark.createDataFrame(asks, "key string, time timestamp"), seconds)
    expected = {}
    for key, time in asks:
        earlier = [(t, v) for k, t, v in events if k == key and time and t and t < time]
        if earlier:
            expected[key, time] = max(earlier)[1]
    assert {(r["key"], r["time"]): r["found"] for r in found.collect()} == expected


def test_revisits_match_plain_search(spark):
    random.seed(12)
    urls = ["http://www.e.org/a?ref=1", "https://e.org/a/", "http://e.org/b", None, "", "#top"]
    rows = []
    for i in range(300):
        tag = random.choice([{"ETag": "1"}, {"etag": "W/1"}, {"ETAG": "2"}, {}, None, {"Last-Modified": "mon"}])
        extra = tag and {**tag, "Content-Length": str(i), "Date": str(i)}
        time = START + timedelta(minutes=random.randint(0, 60)) if i % 20 else None
        rows.append((i, random.choice(urls), time, random.choice([200, 200, 304, 404]), extra, "k", 1))
    rows += [rows[4], (None, urls[0], START, 200, None, "k", 1), (None, urls[0], START + timedelta(hours=2), 304, {"etag": "1"}, "k", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    canonical = dict(spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.canonical_url(F.col("u"))).collect())
    names = lambda h: {k.lower(): v for k, v in (h or {}).items()}
    expected = []
    for i, url, time, status, headers, *_ in rows:
        if status != 304:
            continue
        full = [(t, j) for j, u, t, s, *_ in rows if s == 200 and j is not None and t and time and t < time and canonical[url] and canonical[u] == canonical[url]]
        refers = max(full)[1] if full else None
        state, merged, new = "no_original", None, names(headers)
        if full:
            old = names(next(r[4] for r in rows if r[0] == refers))
            if "etag" in old and "etag" in new:
                agree = old["etag"].removeprefix("W/") == new["etag"].removeprefix("W/")
            else:
                agree = old["last-modified"] == new["last-modified"] if "last-modified" in old and "last-modified" in new else None
            state = {True: "resolved", False: "mismatch", None: "unverified"}[agree]
            if agree:
                merged = sorted({**old, **{k: v for k, v in new.items() if k != "content-length"}}.items())
        expected.append((i, canonical[url], time, refers, state, merged))
    found = [(*r[:5], r[5] and sorted(r[5].items())) for r in warc.resolve(df).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_very_long_urls_and_many_headers(spark):
    url = "http://e.org/" + "deep/" * 20_000 + "?" + "&".join(f"p{i}={i}" for i in range(2_000))
    headers = {f"h{i}": "v" * 50 for i in range(1_000)} | {"etag": "1"}
    rows = [(1, url, START, 200, headers, "k", 1), (2, url + "#x", START + timedelta(hours=1), 304, {"etag": "1", "h5": "new"}, "k", 1)]
    found = warc.resolve(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["refers_to"], r["state"], len(r["headers"]), r["headers"]["h5"]) for r in found] == [(1, "resolved", 1_001, "new")]


def test_empty_table(spark):
    assert warc.resolve(spark.createDataFrame([], SCHEMA)).collect() == []
