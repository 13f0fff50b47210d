"""Toxicity: features, learning on held-in rows only, and accuracy on rows that are held out."""

import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity

LEXICON = toxicity.Lexicon({"idiot": 5.0, "lowe~": 4.0})


def features(text):
    return LEXICON.features(text)


def test_features():
    assert features("") == [0.0] * toxicity.N_FEATURES
    plain = features("A calm and friendly sentence about trees, rivers and birds.")
    rude = features("You IDIOT, loweiung! 1d10t and i.d.i.o.t")
    assert plain[1:8] == [0.0] * 7 and plain[12:] == [0.0, 0.0]
    assert rude[1] > 0 and rude[2] > 0 and rude[4] == 5.0 and rude[7] > 0 and rude[9] > plain[9]
    assert rude[13] == 2.0
    assert len(features("idiot " * 50_000)) == toxicity.N_FEATURES


def test_held_out(spark):
    keys = [*range(200), None, -5]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for key, out in df.select("k", toxicity.held_out(F.col("k"))).collect():
        assert out == (key is not None and zlib.crc32(str(key).encode()) % 5 == 0)


def rows_of(n):
    words = "river tree bird walk calm green sky road house light water stone".split()
    rows, labels = [], []
    for i in range(n):
        text = " ".join(words[(i * 7 + j * j) % 12] for j in range(40 + i % 9))
        toxic = int(i % 4 == 0)
        rows.append((i, text + (" grumbelix you" + " zorkel" * (i % 3) if toxic else ""), 0.5, "s"))
        labels.append((i, 1, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = rows_of(500)
    rows += [(1000, None, 0.5, "s"), (1001, "", 0.5, "s"), (None, "null key", 0.5, "s"), rows[8], (1002, "tree " * 50_000, 0.5, "s")]
    labels += [(None, 1, 1), (3000, 1, None), (4, 1, 0), (8, 1, 1)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, score double, features string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows,
    )


def test_learned_words_reach_held_out_rows(tables):
    documents, labels, rows = tables
    found = toxicity.score_table(documents, labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in found)
    held = [r for r in found if r["held_out"] and r["doc_id"] < 500]
    right = sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    assert len(held) > 60 and right >= 0.95 * len(held)


def test_held_out_labels_are_never_seen(tables):
    documents, labels, _ = tables
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first = sorted(map(str, toxicity.score_table(documents, labels).collect()))
    assert sorted(map(str, toxicity.score_table(documents, turned).collect())) == first


def test_rejecting_keeps_columns_and_clean_rows(tables):
    documents, labels, rows = tables
    kept = toxicity.reject(documents, labels)
    assert kept.columns == documents.columns and kept.exceptAll(documents).count() == 0
    assert kept.where("doc_id < 500 and doc_id % 4 <> 0").count() >= 0.98 * 375
    assert kept.where("doc_id < 500 and doc_id % 4 = 0").count() <= 6


def test_little_to_learn_from(spark, tables):
    documents, labels, rows = tables
    for few, share in ((labels.limit(0), 0.0), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1 and doc_id <> 4"), 1.0)):
        assert {r["score"] for r in toxicity.score_table(documents, few).collect()} == {share}
    assert toxicity.score_table(documents.limit(0), labels).collect() == []
    two = labels.where("doc_id in (1, 2, 3, 12, 16, 20)")
    assert toxicity.score_table(documents, two).count() == len(rows)


def test_a_key_with_many_texts_is_one_example(spark, tables, monkeypatch):
    """A labelled key counts once in learning, however many rows and texts it has."""
    documents, labels, rows = tables
    many = documents.where("doc_id = 8").limit(1).crossJoin(spark.range(300)).withColumn(
        "text", F.concat("text", F.lit(" "), F.col("id").cast("string"))).drop("id")
    seen = []
    real = toxicity.learn_lexicon
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda df: seen.append(df.groupBy("id").count().agg(F.max("count")).first()[0]) or real(df))
    toxicity.fit(documents.unionByName(many), labels)
    assert seen == [1]
