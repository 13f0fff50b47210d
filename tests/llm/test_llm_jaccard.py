"""The n-gram Jaccard join against brute force, with groups round the limit and odd rows."""

import random
import re
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from millrace.llm import jaccard
from millrace.llm.jaccard import JaccardSettings


def grams(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def plain(rows, words=3, percent=90):
    sets = [grams(t, words) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [(k, len(s), least.get(root(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))]


SCHEMA = "doc_id long, text string, node string, component string, id int"


def check(spark, rows, settings=None):
    s = settings or JaccardSettings()
    df = spark.createDataFrame([(k, t, "x", None, 1) for k, t in rows], SCHEMA)
    found = jaccard.join_components(df, settings=settings)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(plain(rows, s.words, s.percent), key=str)


def edited(base, edits, vocabulary):
    text = list(base)
    for _ in range(edits):
        at = random.randrange(len(text))
        text[at : at + random.choice((0, 1, 1))] = [random.choice(vocabulary)] * random.choice((0, 1, 1))
    return text


@pytest.fixture(scope="module")
def rows():
    random.seed(8)
    vocabulary = [f"w{i}" for i in range(90)]
    texts = [None, None, "", " \n\t", "One", "one", "one two", "ONE  two", "one two three", "a\x0bb\x0cc", "É\x1ca b\x85c d", "x " * 4000, "x x x"]
    for length in (3, 5, 9, 10, 11, 12, 13, 20, 21, 22, 30, 45, 80, 150, 400):
        for _ in range(2):
            base = [random.choice(vocabulary) for _ in range(length)]
            for edits in (0, 0, 1, 1, 2, 3, 5, 8):
                texts.append(" ".join(edited(base, min(edits, length // 3), vocabulary)))
    rows = list(enumerate(texts, start=2))
    return rows + [rows[40], rows[40], (None, rows[41][1]), (None, "alone here"), (-5, rows[60][1])]


@pytest.mark.parametrize("most", [None, 0, 64])
def test_all_boundaries_match_brute_force(spark, rows, monkeypatch, most):
    """Enumerated subsets, scanned lists, and pairs across the boundary find the same links."""
    if most is not None:
        monkeypatch.setattr(jaccard, "boundary", lambda nodes, settings: most)
    check(spark, rows)


def test_other_words_and_limits(spark, rows):
    check(spark, rows[:150], JaccardSettings(words=1, percent=75))
    check(spark, rows[:60], JaccardSettings(words=2, percent=100))


def test_hot_group_round_the_limit(spark, monkeypatch):
    """Near copies of one text with one to five edits, a shared passage, and few cells: many members under one key."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 20)
    random.seed(9)
    vocabulary = [f"v{i}" for i in range(400)]
    base, passage = ([random.choice(vocabulary) for _ in range(n)] for n in (150, 60))
    texts = [" ".join(edited(base, 1 + i % 5, vocabulary)) for i in range(250)]
    texts += [" ".join([random.choice(vocabulary) for _ in range(5)] + passage) for _ in range(80)]
    monkeypatch.setattr(jaccard, "CELLS", 64)
    check(spark, list(enumerate(texts)))


def test_prefixes_share_enough_for_all_sizes(spark):
    """For every pair of sizes: a pair that just links has its common elements where the join looks for them."""
    s = JaccardSettings()
    for c in (1, 2):
        df = spark.range(9, 400).withColumnRenamed("id", "n").select("n", s.probe(F.col("n"), c).alias("probe"), s.entered(F.col("n"), c).alias("entered"))
        lengths = {r["n"]: r for r in df.collect()}
        for a in lengths:
            for b in range(a, min(400, a * 100 // 90 + 1)):
                need = next(o for o in range(a + 1) if 100 * o >= 90 * (a + b - o)) if 100 * a >= 90 * b else None
                if need is not None:
                    assert lengths[a]["entered"] >= min(a, a - need + c) and lengths[b]["probe"] >= min(b, b - need + c)


def test_empty_table(spark):
    assert jaccard.join_components(spark.createDataFrame([], SCHEMA)).collect() == []
    check(spark, [(1, None), (1, ""), (None, None)])
