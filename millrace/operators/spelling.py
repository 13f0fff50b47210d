"""Spelling search for large vocabularies: an index that is joined by hash, not a list that is walked.

Two spellings are close when their similarity (see :func:`millrace.operators.categories.similarity`) reaches a
threshold, so the edits allowed between them follow from the longer one. Every spelling is entered under
keys, and any two close ones have a key in common:

* up to ``DELETIONS`` edits: what is left of a spelling when that many characters are deleted, in all ways;
* more edits: a spelling of ``k`` allowed edits is cut into ``k + 1`` even segments, of which one at least is
  whole in any spelling that close; the other side enters its substrings at the places where that can be;
* spellings of more than ``LONG`` characters: a class of lengths.

The hash join finds candidates, an edit distance that stops at the limit decides. The right spellings are at most
``1 / rare_threshold`` per column, whatever the table's size, so the work per spelling is bounded even where
all of them share a segment. They and their keys are broadcast up to ``BROADCAST_BYTES``, so that the keys of the
searched spellings, many for each, stay in the task that makes them; only what was judged close is shuffled. A
spelling makes keys for the lengths that right spellings of its column have, at places that are worked out once
per length.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, present
from millrace.operators.base import TABLE, Fitted, Step
from millrace.plans.counts import value_counts
from millrace.plans.sources import RowSource
from millrace.session import materialize, shared_folder

DELETIONS = 2
LONG = 200
#: Corrections up to this number are broadcast; they are counted first.
BROADCAST_CORRECTIONS = 200_000
#: Right spellings and their keys up to this size are broadcast; beyond it the keys are shuffled.
BROADCAST_BYTES = 64 * 2**20


@dataclass(frozen=True)
class SpellingSettings:
    """``rare_threshold`` is the share from which a spelling is right; it may be as small as the vocabulary needs."""

    columns: tuple[str, ...]
    rare_threshold: float = 0.0001
    similarity_threshold: float = 0.8

    def __post_init__(self):
        if not 0 < self.rare_threshold <= 1:
            raise ValueError("rare_threshold must lie between 0 and 1")
        if not 0.5 <= self.similarity_threshold <= 1:
            raise ValueError("similarity_threshold must lie between 0.5 and 1")


def _edits(length: Column, threshold: float) -> Column:
    """Edits allowed when the longer spelling has this length."""
    return F.floor(length * (1 - threshold) + 1e-9).cast("int")


def _longest_partner(length: Column, threshold: float) -> Column:
    return F.floor(length / threshold + 1e-9).cast("int")


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _deleted(text: Column, most: Column) -> Column:
    """Keys of all remainders after up to ``most`` deletions, ``DELETIONS`` of them at most; none where it is NULL."""
    length = F.char_length(text)

    def without(t: Column, after: Column, deletions: int) -> Column:
        """The remainders of ``text`` that start with ``t``, go on behind place ``after`` and lack so many characters more."""
        if deletions == 0:
            return F.array(_hash(F.lit("d"), F.concat(t, F.substring(text, after + 1, length))))
        return F.flatten(F.transform(
            _whole(after + 1, length - (deletions - 1)),
            lambda i: without(F.concat(t, F.substring(text, after + 1, i - after - 1)), i, deletions - 1)))

    none = F.array().cast("array<bigint>")
    levels = [F.when(most >= n, without(F.lit(""), F.lit(0), n)).otherwise(none) for n in range(DELETIONS + 1)]
    return F.array_distinct(F.concat(*levels))


def _whole(low: Column, high: Column) -> Column:
    """The numbers from low to high, none if there are none."""
    return F.when(low <= high, F.sequence(low.cast("int"), high.cast("int"))).otherwise(F.array().cast("array<int>"))


def _start(i: Column, length: Column, edits: Column) -> Column:
    return F.floor(i * length / (edits + 1)).cast("int")


def _segments(text: Column, length: Column, threshold: float) -> Column:
    """Keys of the segments of a right spelling, for every number of edits a partner may allow."""
    def of(k: Column) -> Column:
        def segment(i: Column) -> Column:
            start, end = _start(i, length, k), _start(i + 1, length, k)
            return _hash(F.lit("s"), k, length, i, F.substring(text, start + 1, end - start))

        return F.transform(_whole(F.lit(0), k), segment)

    first = F.greatest(_edits(length, threshold), F.lit(DELETIONS + 1))
    return F.flatten(F.transform(_whole(first, _edits(_longest_partner(length, threshold), threshold)), of))


def _substrings(text: Column, runs: Column) -> Column:
    """Keys of the places of a spelling where a segment of a right one may be whole; see :func:`_reach`."""
    def of(run: Column) -> Column:
        return F.transform(_whole(run["low"], run["high"]), lambda p: _hash(
            F.lit("s"), run["k"], run["other"], run["i"], F.substring(text, p + 1, run["size"])))

    return F.coalesce(F.flatten(F.transform(runs, of)), F.array().cast("array<bigint>"))


def _reach(right: DataFrame, threshold: float) -> DataFrame:
    """``(column, length, deletions, runs)``: what a spelling of this length, up to ``LONG``, has to look for.

    Both follow from the lengths of the right spellings alone. With ``k`` edits allowed and up to ``DELETIONS``,
    close spellings share a remainder of ``k`` characters less than the longer one. With more, a segment with ``i``
    before it has moved by at most ``i``, and with the rest behind it by at most the rest: a run of places.
    """
    length, other, k = F.col("length"), F.col("other"), F.col("k")
    lengths = right.sparkSession.range(LONG + 1).select(F.col("id").cast("int").alias("length"))
    others = right.select("column", F.char_length("y").alias("other")).where(other <= LONG).distinct()
    longer = F.greatest(length, other)
    pairs = others.join(F.broadcast(lengths), F.abs(length - other) <= _edits(longer, threshold)).withColumn("k", _edits(longer, threshold))

    def run(i: Column) -> Column:
        start, moved = _start(i, other, k), length - other
        size = _start(i + 1, other, k) - start
        low = F.greatest(F.lit(0), start - i, start + moved - (k - i))
        high = F.least(length - size, start + i, start + moved + (k - i))
        return F.struct(k.alias("k"), other.alias("other"), i.alias("i"), size.alias("size"), low.alias("low"), high.alias("high"))

    runs = F.transform(_whole(F.lit(0), F.when(k > DELETIONS, k).otherwise(F.lit(-1))), run)
    deletions = F.when(k <= DELETIONS, k - (longer - length))
    return pairs.groupBy("column", "length").agg(F.max(deletions).alias("deletions"), F.flatten(F.collect_list(runs)).alias("runs"))


def _class(length: Column, threshold: float) -> Column:
    return F.floor(F.log(length) / F.lit(math.log(1 / threshold))).cast("int") if threshold < 1 else length


def right_keys(text: Column, threshold: float) -> Column:
    """Keys under which a right spelling stands."""
    length = F.char_length(text)
    most = F.when(_edits(length, threshold) <= DELETIONS, _edits(_longest_partner(length, threshold), threshold))
    short = F.concat(_deleted(text, most), _segments(text, length, threshold))
    near_long = F.array(_hash(F.lit("l"), _class(length, threshold)))
    return F.when(length <= LONG, F.when(_longest_partner(length, threshold) > LONG, F.concat(short, near_long)).otherwise(short)).otherwise(near_long)


def searched_keys(text: Column, deletions: Column, runs: Column, threshold: float) -> Column:
    """Keys under which a spelling looks for right ones; ``deletions`` and ``runs`` are those of :func:`_reach`."""
    length = F.char_length(text)
    short = F.concat(_deleted(text, deletions), _substrings(text, runs))
    here = _class(length, threshold)
    near_long = F.array(*(_hash(F.lit("l"), here + i) for i in (-1, 0, 1)))
    return F.when(length <= LONG, F.when(_longest_partner(length, threshold) > LONG, F.concat(short, near_long)).otherwise(short)).otherwise(near_long)


def spelling_errors(counts: DataFrame, settings: SpellingSettings) -> DataFrame:
    """``(column, wrong, correct, similarity)`` for spellings close to a more frequent one that is not rare.

    ``counts`` has ``column, value, n``. Among equally similar right spellings the more frequent wins, then the
    alphabetically first.
    """
    threshold = settings.similarity_threshold
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    counted = counts.join(F.broadcast(totals), "column").withColumn("x", F.lower("value"))
    frequent = counted.where(F.col("n") >= F.lit(settings.rare_threshold) * F.col("total"))
    right = materialize(frequent.select(
        F.monotonically_increasing_id().alias("right"), "column", F.col("value").alias("correct"), F.col("n").alias("m"), F.col("x").alias("y")))
    entered = materialize(right.select("right", "column", F.explode(right_keys(F.col("y"), threshold)).alias("part")).select(
        "right", F.xxhash64("column", "part").alias("key")))
    size = right.agg(F.coalesce(F.sum(F.octet_length("correct") + F.octet_length("y")), F.lit(0)).alias("texts")).first()["texts"]
    known = F.broadcast if size + 16 * entered.count() <= BROADCAST_BYTES else lambda table: table

    searched = counted.withColumn("length", F.char_length("x")).join(F.broadcast(_reach(right, threshold)), ["column", "length"], "left")
    keys = searched_keys(F.col("x"), F.col("deletions"), F.col("runs"), threshold)
    searched = searched.select("column", "value", "n", F.explode(keys).alias("part")).select("column", "value", "n", F.xxhash64("column", "part").alias("key"))
    pairs = searched.join(known(entered), "key").drop("key").join(known(right), ["right", "column"])
    pairs = pairs.where((F.col("m") > F.col("n")) & (F.col("value") != F.col("correct"))).withColumn("x", F.lower("value"))
    longest = F.greatest(F.char_length("x"), F.char_length("y"))
    # the distance is -1 where it is over the limit, which the longer spelling sets
    near = F.expr(f"levenshtein(x, y, cast(floor(greatest(char_length(x), char_length(y)) * {1 - threshold!r} + 1e-9) as int))")
    judged = pairs.withColumn("distance", near).where("distance >= 0")
    score = F.when(F.col("distance") == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.col("distance") / longest)
    judged = judged.withColumn("similarity", score).where(F.col("similarity") >= F.lit(threshold))
    # a pair that shares several keys is judged for each of them, which is cheaper than to make pairs distinct first
    best = F.min(F.struct((-F.col("similarity")).alias("s"), (-F.col("m")).alias("m"), "correct")).alias("best")
    return judged.groupBy("column", F.col("value").alias("wrong")).agg(best).select(
        "column", "wrong", F.col("best.correct").alias("correct"), (-F.col("best.s")).alias("similarity"))


def typos_large(df: DataFrame, settings: SpellingSettings) -> DataFrame:
    """The spelling errors of the table's columns; every distinct spelling is judged."""
    return spelling_errors(materialize(value_counts(df, present(df, settings.columns))), settings)


class SpellingModel(Fitted):
    """``state[column]``: the table of corrections learned in training, and how many there are."""

    def _transform(self, df: DataFrame) -> DataFrame:
        for i, name in enumerate(present(df, self.state)):
            learned, wrong, right = self.state[name], f"__wrong{i}", f"__right{i}"
            if not learned["corrections"]:
                continue
            table = df.sparkSession.read.parquet(learned[TABLE]).select(F.col("wrong").alias(wrong), F.col("correct").alias(right))
            if learned["corrections"] <= BROADCAST_CORRECTIONS:
                table = F.broadcast(table)
            order = df.columns
            joined = df.join(table, col(name) == F.col(wrong), "left")
            df = joined.withColumn(name, F.coalesce(F.col(right), col(name))).select(*(col(c) for c in order))
        return df


class CorrectSpelling(Step):
    """Wrong spellings of the training table become the right ones; all others stay as they are."""

    model = SpellingModel

    def learns_from_summaries(self) -> bool:
        return True

    def summary_columns(self, df: DataFrame) -> tuple[list[str], list[str]]:
        return [], present(df, self.settings.columns)

    def learn(self, df: DataFrame, source=None) -> dict[str, dict]:
        names = present(df, self.settings.columns)
        counts = materialize((source or RowSource(df)).counts(names))
        errors, state = materialize(spelling_errors(counts, self.settings)), {}
        numbers = {r["column"]: r["count"] for r in errors.groupBy("column").count().collect()}
        folder = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
        for i, name in enumerate(names):
            path = f"{folder}-{i}.parquet"
            errors.where(F.col("column") == F.lit(name)).select("wrong", "correct").write.parquet(path)
            state[name] = {TABLE: path, "corrections": numbers.get(name, 0)}
        return state
