"""Spelling search against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import spelling
from millrace.operators.mergeable import fit_summary, summary_for
from millrace.operators.spelling import CorrectSpelling, SpellingSettings, spelling_errors, typos_large


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(counts, s):
    totals, out = {}, {}
    for c, _, n in counts:
        totals[c] = totals.get(c, 0) + n
    for c, w, n in counts:
        best = None
        for d, v, m in counts:
            if d == c and m > n and v != w and m >= s.rare_threshold * totals[c]:
                x, y = w.lower(), v.lower()
                score = 1.0 if x == y else 1.0 - distance(x, y) / max(len(x), len(y))
                if score >= s.similarity_threshold:
                    best = min(best or (-score, -m, v), (-score, -m, v))
        if best:
            out[c, w] = (best[2], round(-best[0], 9))
    return out


def vocabulary():
    """Spellings of 1 to 60 characters, with up to a third of their characters edited, in few and many letters."""
    random.seed(11)
    words = {"", "é", "ÄÖ", "a", "ab"}
    for length in (2, 4, 5, 6, 9, 10, 12, 14, 15, 16, 19, 20, 24, 25, 30, 40, 60):
        for letters in ("ab", "abcdefghijklmnop"):
            for _ in range(2):
                base = "".join(random.choice(letters) for _ in range(length))
                words |= {base, base.upper()}
                for edits in range(1, length // 4 + 2):
                    t = list(base)
                    for _ in range(edits):
                        at = random.randrange(len(t) + 1)
                        t[at : at + random.choice((0, 1, 1))] = random.choice((["x"], ["Y"], []))
                    words.add("".join(t))
    return [("c" if i % 3 else "d", w, random.choice((1, 2, 5, 9))) for i, w in enumerate(sorted(words))]


@pytest.mark.parametrize("threshold", [0.8, 0.65, 1.0])
@pytest.mark.parametrize("long", [spelling.LONG, 18])
def test_all_close_spellings_are_found(spark, monkeypatch, threshold, long):
    monkeypatch.setattr(spelling, "LONG", long)
    counts, s = vocabulary(), SpellingSettings(("c", "d"), 0.0001, threshold)
    found = spelling_errors(spark.createDataFrame(counts, "column string, value string, n long"), s).collect()
    assert {(r["column"], r["wrong"]): (r["correct"], round(r["similarity"], 9)) for r in found} == plain(counts, s)


def test_keys_that_are_too_many_to_broadcast_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BROADCAST_BYTES", -1)
    counts, s = vocabulary(), SpellingSettings(("c", "d"))
    found = spelling_errors(spark.createDataFrame(counts, "column string, value string, n long"), s).collect()
    assert {(r["column"], r["wrong"]): (r["correct"], round(r["similarity"], 9)) for r in found} == plain(counts, s)


@pytest.fixture
def large(spark):
    """Spark takes no table for a small one, as at size."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def shuffles(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_keys_of_searched_spellings_are_not_shuffled(spark, large):
    """Every spelling has dozens to hundreds of keys, which must not travel."""
    found = shuffles(spelling_errors(spark.createDataFrame(vocabulary(), "column string, value string, n long"), SpellingSettings(("c", "d"))))
    assert found and not any("key#" in line for line in found), found


def test_learning_corrections_shuffles_spellings_not_keys(spark, large, monkeypatch):
    written, write = [], spelling.materialize
    monkeypatch.setattr(spelling, "materialize", lambda df: written.append(shuffles(df)) or write(df))
    words = [(w,) for _, w, n in vocabulary() for _ in range(n)]
    model = CorrectSpelling(SpellingSettings(("w",))).fit(spark.createDataFrame(words, "w string"))
    assert model.state["w"]["corrections"] > 100
    assert any(written) and not any("key#" in line for lines in written for line in lines), written


def test_step_corrects_what_training_showed(spark):
    rows = [("spelling",)] * 5 + [("speling",), ("Spelling",), (None,), ("other",)]
    df = spark.createDataFrame(rows, "w string").withColumn("n", F.lit(1))
    step = CorrectSpelling(SpellingSettings(("w", "absent"), 0.2))
    model = step.fit(df)
    assert [r["w"] for r in model.transform(df).collect() if r["w"]].count("spelling") == 7
    fresh = spark.createDataFrame([("speling", 1), ("spellin", 2)], "w string, n int")
    assert model.transform(fresh).columns == ["w", "n"]
    assert {r["w"] for r in model.transform(fresh).collect()} == {"spelling", "spellin"}
    merged = summary_for(step, df.limit(4)).merge(summary_for(step, df.exceptAll(df.limit(4))))
    assert fit_summary(step, merged).state["w"]["corrections"] == model.state["w"]["corrections"] == 2


def test_thresholds_and_empty_tables(spark):
    assert typos_large(spark.createDataFrame([], "w string"), SpellingSettings(("w",), 1e-9)).count() == 0
    for wrong in ((0.0, 0.8), (0.1, 0.3)):
        with pytest.raises(ValueError):
            SpellingSettings(("w",), *wrong)
