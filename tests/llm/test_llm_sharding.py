"""Sharding: rendezvous hashing against a plain version, few moves, gapless slots."""

import math
import zlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import sharding

SCHEMA = "doc_id long, text string, shard string, copies int, first int"


def hash_of(text, shard):
    """Two hashes chained: the text's with seed 42 seeds that of the number (4 bytes)."""
    return xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), xxhash.xxh64_intdigest(text.encode(), 42))


def plain_shard(key, weights):
    text = "\0null" if key is None else str(key)
    draws = [(w / -math.log(((hash_of(text, i) >> 12) + 0.5) / 2**52), i) for i, w in enumerate(weights)]
    return max(draws)[1]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"text {i}", "s", 1, 2) for i in range(600)] + [(7, "text 7", "s", 1, 2)] * 30 + [(None, None, None, None, None)] * 3
    return spark.createDataFrame([*data, (1000, "", "s", 1, 2), (1001, "wörter 😀" * 5000, None, 1, 2)], SCHEMA)


@pytest.mark.parametrize("weights", [[1.0] * 16, [1.0, 2.0, 5.0], [3.0]])
def test_shards_match_plain_version(rows, weights):
    for key, shard in rows.select("doc_id", sharding.rendezvous(F.col("doc_id"), weights)).collect():
        assert shard == plain_shard(key, weights)


def test_one_more_shard_takes_rows_only_into_itself(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    moved = sharding.assign(keys, "k", [1.0] * 16, grown_shard="grown").where("shard <> grown")
    assert moved.where("grown <> 16").count() == 0
    assert 20_000 / 17 * 0.85 < moved.count() < 20_000 / 17 * 1.15


def test_weights_decide_shares(spark):
    counts = sharding.assign(spark.range(20_000), "id", [1.0, 3.0]).groupBy("shard").count().collect()
    share = {r["shard"]: r["count"] / 20_000 for r in counts}
    assert abs(share[1] - 0.75) < 0.02


@pytest.mark.parametrize("rows_per_bucket", [5, 100_000])
def test_slots_are_gapless_and_keep_all_rows(rows, rows_per_bucket, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES_PER_STEP", 4)
    found = sharding.number_slots(sharding.assign(rows.drop("shard"), "doc_id", [1.0] * 4), rows_per_bucket=rows_per_bucket)
    slots = defaultdict(list)
    for r in found.collect():
        slots[r["shard"]].append(r["slot"])
    assert sum(map(len, slots.values())) == rows.count()
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert found.drop("slot", "shard").exceptAll(rows.drop("shard")).count() == 0


def test_size_and_checksum(rows):
    for text, size, crc in rows.select("text", sharding.text_size(F.col("text")), sharding.text_crc32(F.col("text"))).collect():
        content = (text or "").encode()
        assert (size, crc) == (len(content) + 1, zlib.crc32(content))


def test_empty_table_and_bad_weights(spark, rows):
    assert sharding.number_slots(sharding.assign(rows.limit(0).drop("shard"), "doc_id", [1.0])).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("doc_id"), [1.0, 0.0])
