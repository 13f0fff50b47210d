"""From raw documents to token ids: reject toxic texts, keep one of each group of near-duplicates, drop
documents that hold benchmark passages, and encode what stays.

Every stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read back as the next
one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bpe, decontaminate, queries, simhash, toxicity
from millrace.session import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a calibrated toxicity below one half."""
    return toxicity.reject(docs, queries.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (fingerprints of three-word shingles, three bits or fewer apart)."""
    return simhash.keep_one(docs, words=simhash.WORDS, distance=simhash.DISTANCE)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontaminate.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes they decode to."""
    return queries.token_digests(docs, bpe.ByteBpe(bpe.path_of(queries.RANK_FILE)))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("byte_bpe", encode_tokens),
]

#: SQL can express neither the learned scores nor the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read back."""
    docs = queries.table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
