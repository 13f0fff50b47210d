"""The pipeline: each stage on its own input, and all of them against their parts."""

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import bpe, decontaminate, simhash, toxicity

NAMES = ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]


def test_stages_are_in_order_and_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.exceptAll(docs).count() == 0 and 0 < out.count() <= docs.count()


def test_run_equals_its_decisions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    calm = docs.join(toxicity.score_table(docs, labels).where("predicted = 0").select("doc_id"), "doc_id", "left_semi")
    single = calm.join(simhash.near_duplicates(calm).where("doc_id = component_id").select("doc_id"), "doc_id", "left_semi")
    clean = single.join(decontaminate.overlaps(single, benchmark).select("doc_id"), "doc_id", "left_anti")
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    own = bpe.Coder(open(bpe.path_of("byte_bpe_50k.tiktoken"), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in found} == set(texts) and len(found) == len(texts)
    for r in found:
        assert r["ids"] == library.encode_ordinary(texts[r["doc_id"]] or "")


def test_hostile_rows(spark, sf_dir):
    """Null keys and texts, empty and long texts, repeats and more columns go through all stages."""
    rows = [(None, None, "x"), (None, "null key text here", "x"), (1, None, "x"), (2, "", "x"), (3, "twice the same", "x"), (3, "twice the same", "x"),
            (4, "long " * 40_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string").withColumn("score", F.lit(1)).withColumn("n_chars", F.length("text"))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() <= len(rows)
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    kept = corpus_pipeline.STAGES[1][1](spark, docs, sf_dir)
    assert kept.where("doc_id = 3").count() == 1 and kept.where("text = 'null key text here'").count() == 1


