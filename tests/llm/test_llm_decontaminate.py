"""Decontamination: masks never miss, and rows match a brute-force search of all alignments."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import decontaminate as dc
from millrace.llm import words as hashing

ITEM_SCHEMA = "item_id long, text string, seed string"
DOC_SCHEMA = "doc_id long, text string, text_hash string, id int"


def test_masks_find_every_run_with_three_substitutions():
    for errors in combinations(range(dc.WINDOW), 3):
        assert any(
            not any(start + offset in errors for offset in mask)
            for mask in dc.MASKS for start in range(dc.WINDOW - mask[-1])
        )


def test_masks_of_short_items_leave_one_whole_for_all_substitutions():
    salts = [salt for n in range(dc.WINDOW + 1) for salt, _ in dc.item_masks(n)]
    assert len(set(salts)) == len(salts)
    for n in range(1, dc.WINDOW):
        masks, errors = dc.short_masks(n), n - -(-4 * n // 5)
        assert len(masks) <= dc.SHORT_MASKS and all(mask and mask[-1] < n for mask in masks)
        for out in combinations(range(n), errors):
            assert any(not set(mask) & set(out) for mask in masks), (n, out)


@pytest.mark.parametrize("most", [1, 14])
def test_short_items_with_all_allowed_substitutions(spark, most):
    """Every item of 1 to 14 words with every allowed choice of changed words is found, one more change is not."""
    lengths = range(1, 15) if most == 14 else (1, 2)
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in lengths]
    docs = []
    for n, text in items:
        errors = n - -(-4 * n // 5)
        for wrong in (errors, errors + 1):
            for out in combinations(range(n), wrong):
                part = ["changed" if k in out else w for k, w in enumerate(text.split())]
                docs.append((len(docs), "before it " * (len(docs) % 3) + " ".join(part) + " behind it" * (len(docs) % 2)))
    found = dc.overlaps(
        spark.createDataFrame([(*d, "h", 1) for d in docs], DOC_SCHEMA), spark.createDataFrame([(*i, "s") for i in items], ITEM_SCHEMA))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == brute(docs, items)


def words_of(text):
    return re.findall(r"\w+", (text or "").lower())


def test_word_hashes_tell_words_apart():
    texts = ["The cat, the CAT sat.", "", "  ", "éa1 Éa1 ÉA2", "x" * 5000 + " y", "a b"]
    hashes, counts = hashing.word_hashes(texts)
    assert counts.tolist() == [len(words_of(t)) for t in texts]
    flat = [w for t in texts for w in words_of(t)]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))
    long = "some words in a line\n" * 100
    whole = hashing.word_hashes([long])[0]
    old, hashing.LONG_TEXT = hashing.LONG_TEXT, 64
    try:
        assert np.array_equal(hashing.word_hashes([long])[0], whole)
    finally:
        hashing.LONG_TEXT = old


def brute(docs, items):
    """All pairs with an aligned run of 15 words (or the whole shorter item) of which 80 % agree."""
    found = set()
    for d, text in docs:
        a = words_of(text)
        for i, item in items:
            b = words_of(item)
            n = min(dc.WINDOW, len(b))
            if b and any(
                sum(x == y for x, y in zip(a[s : s + n], b[t : t + n], strict=False)) >= 0.8 * n
                for s in range(len(a) - n + 1) for t in range(len(b) - n + 1)
            ):
                found.add((d, i))
    return found


@pytest.fixture(scope="module")
def tables(spark):
    random.seed(8)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    make = lambda n: [random.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(make(random.randint(15, 50)))) for i in range(12)]
    items += [(30, items[3][1]), (30, items[4][1]), (31, None), (32, ""), (33, "one two"), (None, items[5][1]), (34, items[6][1].upper())]
    docs = []
    for k in range(60):
        text, item = make(random.randint(0, 80)), random.choice(items[:12])[1].split()
        if k % 3:
            part = list(item)
            if k % 2:
                start = random.randrange(len(item) - 14)
                part = part[start : start + random.randint(15, 40)]
            for at in random.sample(range(len(part)), random.randint(0, len(part) // 4)):
                part[at] = "changed"
            at = random.randint(0, len(text))
            text[at:at] = part
        docs.append((k, random.choice([" ", ", ", "\n"]).join(text)))
    docs += [(500, None), (501, ""), (502, "plain " * 30_000 + items[0][1] + " tail " * 10), docs[1], docs[1], (None, items[7][1])]
    return (
        spark.createDataFrame([(*d, "h", 1) for d in docs], DOC_SCHEMA),
        spark.createDataFrame([(*i, "s") for i in items], ITEM_SCHEMA), docs, items,
    )


def test_pairs_match_brute_force(tables):
    documents, benchmark, docs, items = tables
    rows = dc.overlaps(documents, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == brute(docs[:62] + docs[63:], items) | {(502, 0)}
    text = {}
    for d, t in docs:
        text.setdefault(d, words_of(t))
    one = {i: words_of(t) for i, t in items if i != 30}
    for r in rows:
        if r["item_id"] == 30:
            continue
        a = text[r["doc_id"]][r["start"] : r["start"] + r["n_words"]]
        b = one[r["item_id"]][r["item_start"] : r["item_start"] + r["n_words"]]
        assert len(a) == len(b) == r["n_words"] and r["n_same"] == sum(x == y for x, y in zip(a, b, strict=True))


def test_a_full_bit_table_changes_nothing(tables, monkeypatch):
    documents, benchmark, _, _ = tables
    expected = sorted(map(tuple, dc.overlaps(documents, benchmark).collect()), key=str)
    monkeypatch.setattr(dc, "LEAST_BITS", 3)
    monkeypatch.setattr(dc, "MOST_BITS", 3)
    assert sorted(map(tuple, dc.overlaps(documents, benchmark).collect()), key=str) == expected


def test_only_clean_rows_stay(tables):
    documents, benchmark, docs, items = tables
    bad = {d for d, _ in brute(docs[:62] + docs[63:], items)} | {502}
    kept = dc.decontaminate(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


def test_empty_tables(spark, tables):
    documents, benchmark, docs, _ = tables
    assert dc.overlaps(documents.limit(0), benchmark).count() == 0
    assert dc.overlaps(documents, benchmark.limit(0)).count() == 0
    assert dc.decontaminate(documents, benchmark.limit(0)).count() == len(docs)
    with pytest.raises(ValueError):
        dc.overlaps(documents, benchmark, similarity=0.7)
