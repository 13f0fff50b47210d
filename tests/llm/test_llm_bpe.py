"""Byte-level BPE against the tokenizer library, and an exact round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
OWN = bpe.Coder(open(PATH, "rb").read())
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=OWN.ranks, special_tokens={})
SIGNS = "aAsStTrRevVmMlLdD''''  \n\t\r 　!?.,-19é ßЖ中文😀\x1c\x85́½"


def encoded(texts):
    ids, counts = bpe.encode_texts(OWN, texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(SIGNS), max_size=24) | st.text(max_size=12), min_size=1, max_size=8))
def test_texts_match_the_library(texts):
    assert encoded(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_every_code_point_matches_the_library():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a".join(points[i : i + 4096]) for i in range(0, len(points), 4096)]
    for at in range(0, len(texts), 16):
        assert encoded(texts[at : at + 16]) == [LIBRARY.encode_ordinary(t) for t in texts[at : at + 16]]


def test_long_text_in_parts(monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 50)
    random.seed(3)
    for text in ["x" * 400, " " * 400, "word " * 300, "".join(random.choice(SIGNS + "   ab") for _ in range(3000))]:
        ids, counts = bpe.encode_texts(OWN, [text])
        assert "".join(bpe.long_text_parts(text, 50)) == text
        assert ids.tolist() == LIBRARY.encode_ordinary(text) and counts.tolist() == [len(ids)]


def test_long_pieces_and_a_small_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    random.seed(4)
    texts = ["".join(random.choice("abcdeé") for _ in range(n)) for n in (1, 2, 31, 32, 33, 64, 500, 20_000)]
    for _ in range(2):
        assert encoded(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


@pytest.fixture(scope="module")
def coder():
    return bpe.ByteBpe(PATH)


def test_frames_round_trip(spark, coder):
    texts = [None, "", "it's 'round  trip\n\n", "😀 it'll" * 20_000, "same", "same", "\x00 end "]
    df = spark.createDataFrame([(i % 3 or None, t, 1.5, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids double, decoded string")
    rows = coder.decode(coder.encode(df)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        text = row["text"] or ""
        assert row["ids"] == LIBRARY.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
        ends = np.cumsum([len(LIBRARY.decode_single_token_bytes(i)) for i in row["ids"]]).tolist()
        assert row["offsets"] == [0, *ends][: len(row["ids"])]


def test_decoding_in_the_same_pass(spark, coder):
    texts = [None, "", "héllo wörld", "", "😀", " \n "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = coder.encode(df, decoded="back").orderBy("doc_id").collect()
    assert [bytes(r["back"]).decode() for r in rows] == [t or "" for t in texts]
    assert coder.encode(df.limit(0), decoded="back").collect() == []


def test_empty_table_and_null_ids(spark, coder):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert coder.decode(coder.encode(empty)).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in coder.decode(nulls).collect()] == [b"", b""]
