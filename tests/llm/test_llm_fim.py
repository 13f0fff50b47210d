"""Fill-in-middle against a plain version, exact round trips, and odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import fim


def plain(key, text, s):
    digest = hashlib.sha256(f"{s.salt}{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    text = text or ""
    n = len(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if not text or any(m in text for m in (s.prefix, s.suffix, s.middle)) or h[2] % 100 >= s.transformed:
        return n, "plain", None, None, text
    if h[3] % 100 < s.suffix_first:
        return n, "spm", low, high - low, s.suffix + suffix + s.prefix + prefix + s.middle + middle
    return n, "psm", low, high - low, s.prefix + prefix + s.suffix + suffix + s.middle + middle


SCHEMA = "doc_id long, text string, n string, form int, output string, `a.b` string"


@pytest.fixture(scope="module")
def rows():
    random.seed(3)
    alphabet = "ab é世𝄞\n<>PSḾ"
    rows = [(None, None), (None, "keyless"), (1, None), (2, ""), (3, "x"), (3, "x"), (4, "a<P>b"), (5, "<S>"), (6, "ends with <"), (7, "<S" * 40)]
    rows += [(i, "".join(random.choice(alphabet) for _ in range(random.randrange(1, 90)))) for i in range(10, 300)]
    rows.append((400, "".join(random.choice(alphabet) for _ in range(50_000))))
    return rows


@pytest.mark.parametrize("most", [fim.MOST_UNITS, 7])
def test_rows_match_plain_version(spark, rows, most):
    s = fim.FimSettings()
    df = spark.createDataFrame([(k, t, "old", 1, "old", "kept") for k, t in rows], SCHEMA)
    made = fim.transform(df, most=most)
    assert made.columns == ["doc_id", "text", "a.b", "n", "form", "prefix_chars", "middle_chars", "output"]
    found = [tuple(r) for r in made.collect()]
    expected = [(k, t, "kept", *plain(k, t, s)) for k, t in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    back = made.select(F.coalesce("text", F.lit("")).alias("t"), fim.restore(F.col("output"), F.col("form")).alias("r"))
    assert back.where("t <> r").count() == 0
    assert {r["form"] for r in made.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_other_units_and_sentinels(spark):
    s = fim.FimSettings(prefix="[pre]", suffix="[suf]", middle="[mid]", transformed=100, suffix_first=0, unit=r"\S+\s*|\s+")
    df = spark.createDataFrame([(i, "one two  three\nfour " * 3 + "five") for i in range(20)], "doc_id long, text string")
    made = fim.transform(df, settings=s)
    assert {r["n"] for r in made.collect()} == {13}
    for r in made.collect():
        start = r["text"][: r["prefix_chars"]]
        assert start == "" or start[-1].isspace() or start == r["text"]
    assert made.where(fim.restore(F.col("output"), F.col("form"), s) != F.col("text")).count() == 0


def test_runs_give_the_same_cuts_as_one_match():
    text, whole = "ab世 " * 500, fim.UnitCutter()
    for most in (1, 3, 64, 1999, 2000):
        cutter = fim.UnitCutter(most=most)
        for first, second in ((0, 2000), (1, 64), (63, 2001), (1999, 128)):
            assert cutter.cuts(text, first, second) == whole.cuts(text, first, second)


def test_units_with_gaps_and_bad_sentinels_are_refused():
    with pytest.raises(ValueError):
        fim.UnitCutter(r"\w").cuts("a b", 1, 1)
    for wrong in ({"prefix": "<S>"}, {"prefix": "<<S>"}, {"prefix": ">x", "suffix": "y>"}, {"middle": ""}, {"transformed": 101}):
        with pytest.raises(ValueError):
            fim.FimSettings(**wrong)


def test_empty_table(spark):
    assert fim.transform(spark.createDataFrame([], SCHEMA)).collect() == []
