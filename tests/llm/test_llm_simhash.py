"""SimHash near-duplicates against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from millrace.llm import components, simhash


def plain_fingerprint(text, words=3):
    found = (text or "").encode()
    found = bytes(c + 32 if 65 <= c <= 90 else c for c in found)
    for c in b"\t\n\v\f\r":
        found = found.replace(bytes([c]), b" ")
    found = [w for w in found.split(b" ") if w]
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(numbers, distance=3):
    label = {n: n for n in numbers}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in combinations(sorted(label), 2):
        if (a ^ b).bit_count() <= distance:
            label[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in numbers}


TEXTS = [None, "", " \n\t", "One", "one two", "One  TWO\nthree", "one two three", "É\x1cA b\x85c d", "x " * 3000, "a b c d e f g"]


def test_fingerprints():
    for text in TEXTS:
        assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)


@pytest.mark.parametrize("distinct", [10, 10_000, 10**7, 3 * 10**10])
def test_thresholds_hold_the_pigeonhole(distinct):
    random.seed(distinct)
    bits = np.array([[random.random() < 0.5 for _ in range(64)] for _ in range(200)], np.uint8)
    partitions = simhash.plan(bits, distinct)
    assert sum(p.threshold + 1 for p in partitions) == simhash.DISTANCE + 1
    assert len({b for p in partitions for b in p.bits}) == sum(len(p.bits) for p in partitions)


def test_correlated_bits_share_a_partition():
    random.seed(1)
    base = np.array([[random.random() < 0.5 for _ in range(8)] for _ in range(400)], np.uint8)
    bits = np.tile(base, 8)
    for group in simhash.correlated_groups(bits, 4):
        assert len({b % 8 for b in group}) <= 3


@pytest.mark.parametrize("distinct", [None, 10**8, 3 * 10**10])
def test_links_match_brute_force(spark, monkeypatch, distinct):
    """All plans, those for very large tables too, find every link."""
    random.seed(5)
    base = [random.getrandbits(64) for _ in range(12)]
    numbers = {0, (1 << 64) - 1, *base}
    for b in base:
        for n in range(5):
            numbers.add(b ^ sum(1 << x for x in random.sample(range(64), n)))
    if distinct:
        real = simhash.plan
        monkeypatch.setattr(simhash, "plan", lambda bits, _, distance: real(bits, distinct, distance))
    nodes = spark.createDataFrame([(simhash.signed(n),) for n in numbers], "fp long")
    found = {(r["a"], r["b"]) for r in simhash.links(nodes).collect()}
    signed = sorted(simhash.signed(n) for n in numbers)
    mask = (1 << 64) - 1
    assert found == {(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & mask).bit_count() <= 3}


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(5, 4), (4, 5), (7, 7), (200, 201), (None, 3)]
    found = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(found.get(i, i) == 0 for i in range(41)) and all(found.get(i, i) == 100 for i in range(100, 130))
    assert found[201] == 200
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.fixture(scope="module")
def documents(spark):
    random.seed(6)
    words = [f"w{i}" for i in range(60)]
    texts = list(TEXTS)
    for _ in range(12):
        text = [random.choice(words) for _ in range(300)]
        for n in (0, 0, 1, 2, 3):
            copy = list(text)
            for at in random.sample(range(300), n):
                copy[at] = random.choice(words)
            texts.append(" ".join(copy))
    rows = [(i, t, 1, f"c{i}") for i, t in enumerate(texts, start=3)]
    rows += [rows[12], rows[12], (None, rows[14][1], 2, None), (None, "alone in the world", 2, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, text_hash int, fp string")


def test_rows_match_brute_force(documents):
    rows = documents.collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    root = brute_components(set(prints))
    least = {}
    for row, p in zip(rows, prints, strict=True):
        if row["doc_id"] is not None:
            least[root[p]] = min(least.get(root[p], row["doc_id"]), row["doc_id"])
    expected = [(r["doc_id"], f"{p:016x}", least.get(root[p])) for r, p in zip(rows, prints, strict=True)]
    found = [tuple(r) for r in simhash.near_duplicates(documents).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_empty_table(spark, documents):
    assert simhash.near_duplicates(documents.limit(0)).collect() == []


def test_one_row_of_each_component_stays(spark, documents):
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    rows = documents.collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    root, best = brute_components(set(prints)), {}
    for row, p in zip(rows, prints, strict=True):
        order = (row["doc_id"] is None, row["doc_id"] or 0)
        if root[p] not in best or order < best[root[p]]:
            best[root[p]] = order
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert found == sorted(best.values())
    assert simhash.keep_one(documents.limit(0)).collect() == []


def test_repeated_rows_and_keys_leave_one_row(spark):
    rows = [(3, "same words here"), (3, "same words here"), (3, "quite other words are here"), (None, "same words here"), (9, None), (8, ""), (None, "x y z q")]
    kept = simhash.keep_one(spark.createDataFrame(rows * 2, "doc_id long, text string"))
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(
        [(3, "same words here"), (3, "quite other words are here"), (8, ""), (None, "x y z q")], key=str)
