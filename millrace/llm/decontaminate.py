"""Benchmark decontamination by spaced seeds: hashes that ignore fixed word positions, joined and verified.

A mask names the positions of a short window of words that count; the others may hold anything. Every
place of every text gives one hash for each mask. The masks here find, for certain, any aligned run of
``WINDOW`` words of which at least ``SIMILARITY`` agree; an item of fewer words has masks of its own, which start
at its first word. ``tests/llm`` goes through all cases. Places
whose hash can be a benchmark hash are found in the scan by a bit table of fixed size; only the words
around them go on. The hash join then pairs them with benchmark places, and each pair is verified word
by word along its diagonal, so that neither the bit table nor a hash decides anything.

A text contains a benchmark item if ``WINDOW`` consecutive words of both, or all words of a shorter item,
agree in at least the share ``SIMILARITY``, substitutions allowed.

Defined results: null and empty texts contain nothing; items without a word are not looked for, items of one word
are found wherever it stands; an empty benchmark finds nothing. Benchmark rows with equal ids are searched one by
one and reported under that id. Repeated text rows are reported once for each id and text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.frames import col, fresh, lists, ready_workers, text_chunks, text_of, without
from millrace.llm.words import word_hashes
from millrace.session import materialize

#: Positions that count. With these two, 3 substitutions among 15 words never hide a run.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5))
WINDOW = 15
SIMILARITY = 0.8
#: Masks that an item of fewer words than the window has at most.
SHORT_MASKS = 8
#: Bits of the table for each benchmark hash, and its least and largest size in bits.
BITS_PER_HASH, LEAST_BITS, MOST_BITS = 1024, 20, 27
MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def short_masks(length: int) -> list[tuple[int, ...]]:
    """Masks from the first word of an item of fewer words than the window: the words are cut into two blocks more
    than substitutions are allowed, or one, and every choice that leaves out as many blocks as there are
    substitutions is a mask. Any substitutions then leave one mask whole."""
    errors = length - math.ceil(SIMILARITY * length - 1e-9)
    blocks = min(length, errors + 2) if errors else 1
    cut = [range(b * length // blocks, (b + 1) * length // blocks) for b in range(blocks)]
    return [tuple(w for b, words in enumerate(cut) if b not in out for w in words) for out in combinations(range(blocks), errors)]


def item_masks(length: int) -> list[tuple[int, tuple[int, ...]]]:
    """Salt and mask of all seeds of an item with this many words."""
    if length >= WINDOW:
        return list(enumerate(MASKS))
    return [(len(MASKS) + SHORT_MASKS * length + i, mask) for i, mask in enumerate(short_masks(length))] if length else []


def seed_hashes(words: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """The hash of each place at which the mask fits."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    value = np.full(n, np.uint64(salt + 1))
    for offset in mask:
        value = (value ^ words[offset : offset + n]) * MULTIPLIER
        value ^= value >> np.uint64(32)
    return value


def places(words: np.ndarray, per_text: np.ndarray, mask: tuple[int, ...], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, and the places (in all words) they start at, of masks that lie within one text."""
    hashes = seed_hashes(words, mask, salt)
    ends = np.repeat(np.cumsum(per_text), per_text)
    at = np.flatnonzero(np.arange(len(hashes)) + mask[-1] < ends[: len(hashes)])
    return hashes[at], at


ITEM = T.StructType([
    T.StructField("item", T.LongType()), T.StructField("item_words", T.ArrayType(T.LongType(), False)),
    T.StructField("seeds", T.ArrayType(T.LongType(), False)), T.StructField("places", T.ArrayType(T.IntegerType(), False)),
])


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words and all seeds of every benchmark row."""
    arrow = to_arrow_schema(ITEM)
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            words, per_text = word_hashes(text_of(one, "text"))
            own = [places(words, per_text, mask, salt) for salt, mask in item_masks(len(words))]
            found = own if len(words) >= WINDOW else [(hashes[:1], at[:1]) for hashes, at in own]
            found.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            seeds, at = (np.concatenate(part) for part in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([
                one.column("item").cast(pa.int64()), lists(words.view(np.int64), np.array([len(words)])),
                lists(seeds.view(np.int64), np.array([len(seeds)])), lists(at.astype(np.int32), np.array([len(at)])),
            ], schema=arrow)


def bit_table(seeds: DataFrame) -> tuple[np.ndarray, int]:
    """A bit table with two bits set for each seed: its size is bounded, whatever the benchmark holds."""
    count = seeds.count()
    size = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, count) * BITS_PER_HASH))))
    at = F.explode(F.array(F.col("seed"), F.shiftright("seed", 32))).alias("at")
    place = F.col("at").bitwiseAND(F.lit((1 << size) - 1))
    placed = seeds.select(at).select(place.alias("place"))
    octets = placed.groupBy(F.shiftright("place", 3).alias("octet")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(place & 7 as int))")).alias("bits"))
    table = np.zeros(1 << (size - 3), np.uint8)
    found = octets.toPandas()
    table[found["octet"].to_numpy()] = found["bits"].to_numpy()
    return table, size


def possible(hashes: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    """The hashes whose two bits are set."""
    most = np.uint64((1 << size) - 1)

    def is_set(number: np.ndarray) -> np.ndarray:
        place = number & most
        return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1

    at = np.flatnonzero(is_set(hashes))
    return at[is_set(hashes[at] >> np.uint64(32))]


def _segments(marks: np.ndarray, margin: int, words: int) -> list[tuple[int, int, int, int]]:
    """Runs of marked places with a margin: first and last mark, first word and the word behind the last."""
    cut = np.flatnonzero(np.diff(marks) > 2 * margin)
    firsts, lasts = np.append(0, cut + 1), np.append(cut, len(marks) - 1)
    return [
        (int(a), int(b), max(0, int(marks[a]) - margin), min(words, int(marks[b]) + margin))
        for a, b in zip(firsts, lasts, strict=True)
    ]


def suspects(df: DataFrame, key: str, text: str, table: np.ndarray, size: int, lengths: list[int]) -> DataFrame:
    """Places that may start a benchmark seed, with the words around them: one row for each run of places.

    ``place`` numbers words within the run, which starts at word ``first`` of the text. ``lengths`` are those of the
    items, as far as they are below the window; only their masks are tried besides the common ones.
    """
    ready_workers(df.sparkSession)
    source = df.select(col(key).alias("id"), F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))
    schema = T.StructType([
        *source.schema.fields[:2], T.StructField("first", T.IntegerType()),
        T.StructField("words", T.ArrayType(T.LongType(), False)), T.StructField("seeds", T.ArrayType(T.LongType(), False)),
        T.StructField("places", T.ArrayType(T.IntegerType(), False)),
    ])
    arrow, shared = to_arrow_schema(schema), df.sparkSession.sparkContext.broadcast(table)
    margin = WINDOW + max(m[-1] for m in MASKS) + 1
    masks = item_masks(WINDOW) + [mask for n in lengths for mask in item_masks(n)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                words, per_text = word_hashes(text_of(chunk, "text"))
                seeds, at = [], []
                for salt, mask in masks:
                    hashes, starts = places(words, per_text, mask, salt)
                    hit = possible(hashes, bits, size)
                    seeds.append(hashes[hit])
                    at.append(starts[hit])
                seeds, at = np.concatenate(seeds), np.concatenate(at)
                order = np.argsort(at, kind="stable")
                seeds, at = seeds[order], at[order]
                ends = np.cumsum(per_text)
                bounds = np.searchsorted(at, np.append(0, ends))
                rows = []
                for i in np.flatnonzero(np.diff(bounds)).tolist():
                    low, high, base = bounds[i], bounds[i + 1], int(ends[i] - per_text[i])
                    marks = at[low:high] - base
                    for a, b, start, stop in _segments(marks, margin, int(per_text[i])):
                        rows.append((
                            i, start, words[base + start : base + stop], seeds[low + a : low + b + 1], marks[a : b + 1] - start,
                        ))
                if rows:
                    where = pa.array([r[0] for r in rows])
                    yield pa.RecordBatch.from_arrays([
                        chunk.column("id").take(where), chunk.column("text_hash").take(where),
                        pa.array([r[1] for r in rows], pa.int32()),
                        *(lists(np.concatenate([r[k] for r in rows]).astype(kind, copy=False).view(view), np.array([len(r[k]) for r in rows]))
                          for k, kind, view in ((2, np.uint64, np.int64), (3, np.uint64, np.int64), (4, np.int32, np.int32))),
                    ], schema=arrow)

    return source.mapInArrow(work, schema)


def best_overlap(words: np.ndarray, item: np.ndarray, diagonals: list[int], window: int, similarity: float,
                 ) -> tuple[int, int, int, int] | None:
    """The aligned overlap with the most agreeing words: start in the text, start in the item, words, agreeing.

    On each diagonal (text place minus item place) every run of ``window`` words, or of the whole item if
    that is shorter, is judged; runs that pass are joined where they overlap.
    """
    window, best = min(window, len(item)), None
    for diagonal in diagonals:
        low, high = max(0, -diagonal), min(len(item), len(words) - diagonal)
        if high - low < window:
            continue
        same = np.append(0, np.cumsum(words[low + diagonal : high + diagonal] == item[low:high]))
        good = np.flatnonzero(same[window:] - same[:-window] >= similarity * window - 1e-9)
        for run in np.split(good, np.flatnonzero(np.diff(good) > window) + 1) if len(good) else ():
            a, b = int(run[0]), int(run[-1]) + window
            found = (int(same[b] - same[a]), -(b - a), -(low + a + diagonal), -(low + a))
            best = max(best or found, found)
    return best and (-best[2], -best[3], -best[1], best[0])


OVERLAP = "struct<start:int,item_start:int,n_words:int,n_same:int>"


def overlaps(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
             item_text: str = "text", window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """The best overlap of every text with every benchmark item it contains.

    Columns: the key, the item's key, ``text_hash``, the first word of the overlap in the text and in the
    item, its words, the words that agree, and their share. ``window`` and ``similarity`` may be raised;
    the masks are sure to find what the defaults ask for.
    """
    if math.ceil(similarity * window - 1e-9) < window - 3 or window < WINDOW:
        raise ValueError("the masks are not sure to find overlaps of that kind")
    ready_workers(df.sparkSession)
    tests = benchmark.select(col(item_key).cast("long").alias("item"), col(item_text).alias("text"))
    items = materialize(
        tests.mapInArrow(_items, ITEM).withColumn("item_row", F.xxhash64("item", "item_words")).dropDuplicates(["item", "item_row"])
    )
    seeds = items.select("item", "item_row", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        "item", "item_row", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_place"))
    table, size = bit_table(seeds)
    short = items.select(F.size("item_words").alias("n")).where(F.col("n").between(1, WINDOW - 1)).distinct().collect()  # 14 numbers at most
    runs = materialize(suspects(df, key, text, table, size, sorted(r["n"] for r in short)).distinct())
    row = ["id", "text_hash", "first"]
    hits = runs.select(*row, F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        *row, F.col("s.seeds").alias("seed"), F.col("s.places").alias("place"))
    pairs = hits.join(seeds, "seed").groupBy(*row, "item", "item_row").agg(
        F.collect_set(F.col("place") - F.col("item_place")).alias("diagonals"))

    def verify(words: pa.Array, item_words: pa.Array, diagonals: pa.Array) -> pa.Array:
        found = []
        for w, i, d in zip(words, item_words, diagonals, strict=True):
            best = best_overlap(
                w.values.to_numpy(zero_copy_only=False), i.values.to_numpy(zero_copy_only=False), sorted(d.as_py()), window, similarity)
            found.append(best and dict(zip(("start", "item_start", "n_words", "n_same"), best, strict=True)))
        fields = [pa.field(n, pa.int32()) for n in ("start", "item_start", "n_words", "n_same")]
        return pa.array(found, pa.struct(fields))

    verify.__annotations__ = {"words": pa.Array, "item_words": pa.Array, "diagonals": pa.Array, "return": pa.Array}
    same_run = [F.col(f"p.{c}").eqNullSafe(F.col(f"r.{c}")) for c in row]
    same_item = [F.col(f"p.{c}").eqNullSafe(F.col(f"i.{c}")) for c in ("item", "item_row")]
    judged = (
        pairs.alias("p").join(runs.select(*row, "words").alias("r"), same_run).join(items.alias("i"), same_item)
        .select("p.id", "p.text_hash", "p.first", "p.item",
                F.arrow_udf(verify, OVERLAP)("r.words", "i.item_words", "p.diagonals").alias("o"))
        .where("o is not null")
    )
    best = judged.groupBy("id", "text_hash", "item").agg(F.max(F.struct(
        F.col("o.n_same"), (-F.col("o.n_words")).alias("n"), (-(F.col("first") + F.col("o.start"))).alias("s"),
        (-F.col("o.item_start")).alias("i"))).alias("o"))
    return best.select(
        F.col("id").alias(key), F.col("item").alias(item_key), "text_hash", (-F.col("o.s")).alias("start"),
        (-F.col("o.i")).alias("item_start"), (-F.col("o.n")).alias("n_words"), F.col("o.n_same").alias("n_same"),
        (F.col("o.n_same") / -F.col("o.n")).alias("similarity"),
    )


def decontaminate(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows whose text contains no benchmark item."""
    found = materialize(overlaps(df, benchmark, key, text, **settings).select(
        col(key).alias("id"), "text_hash").distinct())
    hashed = fresh(df, "text_hash")
    marked = df.withColumn(hashed, F.xxhash64(col(text)))
    return without(marked, found, {key: "id", hashed: "text_hash"}).drop(hashed)
