"""Importance resampling against a plain version, ties, and the bisection on its own."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import resample
from millrace.llm.resample import ResampleSettings


def features(text, longest):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, s):
    def counts(texts):
        found = [0] * s.buckets
        for t in texts:
            for f in features(t, s.longest)[1]:
                found[zlib.crc32(f.encode()) % s.buckets] += 1
        return found

    a, b = counts([t for _, t in rows]), counts(target)
    gains = [math.floor(1000 * math.log((y + 1.0) * (sum(a) + s.buckets) / ((x + 1.0) * (sum(b) + s.buckets)))) for x, y in zip(a, b, strict=True)]
    out = []
    for key, text in rows:
        words, found = features(text, s.longest)
        weight = sum(gains[zlib.crc32(f.encode()) % s.buckets] for f in found)
        h = int(hashlib.sha256(f"{s.salt}{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((i for i, r in enumerate(out) if r[1] >= s.least_words), key=lambda i: (-out[i][4], out[i][0] is None, out[i][0] or 0))
    drawn = {i: place + 1 for place, i in enumerate(fit[: s.percent * len(fit) // 100])}
    return [tuple(r) + (drawn.get(i),) for i, r in enumerate(out)]


SCHEMA = "doc_id long, text string, weight string, score string, key int, at int"


def table(spark, rows):
    return spark.createDataFrame([(k, t, "x", "x", 1, 1) for k, t in rows], SCHEMA)


def texts(n, seed):
    random.seed(seed)
    words = ["Apple", "pear", "é́té", "世界", "x1", "Zug", "go", "stop", "naïve", "42"]
    return [" ".join(random.choice(words[: 3 + i % 8]) for _ in range(random.randrange(0, 60))) for i in range(n)]


@pytest.mark.parametrize("settings", [ResampleSettings(), ResampleSettings(longest=3, buckets=50, least_words=3, percent=37, salt="s")])
def test_rows_match_plain_version(spark, settings, monkeypatch):
    monkeypatch.setattr(resample, "LONG_TEXT", 50)
    rows = [(i, t) for i, t in enumerate(texts(300, 1), start=-20)] + [(None, "go " * 40), (None, None), (900, ""), (901, "go stop " * 3000)]
    target = [*texts(20, 2)[::2], None, "pear pear"]
    found = resample.resample(table(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"), settings=settings)
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(plain(rows, target, settings), key=str)


def test_ties_and_repeated_rows(spark):
    """Equal texts and keys: as many rows as asked, ranks without gaps, smaller keys first, null keys last."""
    rows = [(7, "go " * 30)] * 40 + [(None, "go " * 30)] * 30 + [(3, "go " * 30)] * 30
    for percent in (1, 25, 30, 31, 69, 85, 100):
        found = resample.resample(table(spark, rows), table(spark, []), settings=ResampleSettings(percent=percent)).collect()
        drawn = sorted((r["rank"], -r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in found if r["rank"])
        assert [d[0] for d in drawn] == list(range(1, percent + 1)) and len(found) == 100
        assert [d[1:] for d in drawn] == sorted(d[1:] for d in drawn)


def test_ties_at_the_cutoff_go_to_smaller_keys(spark, monkeypatch):
    monkeypatch.setattr(resample, "gumbel", lambda key, salt: F.lit(0).cast("long"))
    rows = [(k, "go " * 30) for k in (5, -9, 2**62, -(2**63), 8, 0, None, 11, 4, 6)]
    for percent, keys in ((30, [-(2**63), -9, 0]), (60, [-(2**63), -9, 0, 4, 5, 6]), (90, [-(2**63), -9, 0, 4, 5, 6, 8, 11, 2**62]), (100, None)):
        found = resample.resample(table(spark, rows), table(spark, []), settings=ResampleSettings(percent=percent)).where("rank is not null").orderBy("rank")
        got = [r["doc_id"] for r in found.collect()]
        assert got == keys if keys else got[-1] is None and len(got) == 10


def test_bisection(spark):
    random.seed(4)
    values = [random.randrange(-50, 50) ** 3 for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(values, reverse=True)
    for wanted in (1, 2, 77, 499, 500):
        for levels in (1, 4):
            cut, above = resample.bisect(df, "v", wanted, min(values), max(values), levels)
            assert cut == ordered[wanted - 1] and above == sum(v > cut for v in values)


def test_empty_tables(spark):
    none = table(spark, [])
    assert resample.resample(none, none).collect() == []
    assert [r["rank"] for r in resample.resample(table(spark, [(1, "few words")]), none).collect()] == [None]
