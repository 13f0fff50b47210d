"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features: densities of a lexicon of words and word starts, how near its words stand to a second-person
pronoun, capitals, punctuation, and rates of obfuscated spellings. The lexicon is a short list of common
insults plus what the training labels show: words and word starts that are far more frequent in toxic
texts. Learning looks at labelled rows only, at most ``sample_rows`` of them, chosen by a hash of the
key; they are split by another hash into rows for the lexicon, the trees and the calibration, so that
none judges its own findings. Scoring is one pass over the table and needs nothing but the text.

Defined results: null and empty texts have all features 0 and get a score like any other. Labels that
are null are left out; a key with several labels counts as toxic if any says so. Without a toxic or
without a clean training row the score is the share of toxic ones (0 without any). Repeated rows get
equal scores. Columns named like the new ones are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.frames import col, fresh, ready_workers, text_chunks, text_of
from millrace.session import materialize

#: Common insults that the lexicon starts with.
INSULTS = (
    "idiot idiots idiotic moron morons moronic stupid loser losers scum trash pathetic worthless disgusting clown "
    "dumb fool imbecile jerk bastard bitch asshole crap shit fuck fucking damn retard whore slut freak garbage vermin "
    "dumm trottel arschloch dreck idiota imbécil estúpido basura idiote imbécile connard stupide"
).split()
#: Second-person pronouns in the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split()
)
#: Signs that stand for letters.
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""})

WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"(?<![\w@$*!])[0-9@$*!]{0,2}[^\W\d_]+(?:[0-9@$*!]+[^\W\d_]+)+(?![\w@$*!])|\b[^\W\d_](?:[.\-_ ][^\W\d_]){3,}\b")
PUNCTUATION = re.compile(r"[^\w\s]")
SHOUT = re.compile(r"[!?]")
#: Lengths of the word starts in the lexicon.
STARTS = (4, 5, 6)
#: A lexicon entry is in this share of the toxic texts at least, and in so many of them.
LEAST_SHARE, LEAST_TEXTS = 0.02, 3
#: The least log ratio of its share among toxic texts to that among clean ones, and the most entries.
LEAST_RATIO, MOST_ENTRIES = 2.5, 2_000
#: Words between an entry and a pronoun that count as near.
NEAR = 5
#: Labelled rows that learning looks at, at most.
SAMPLE_ROWS = 20_000
#: Words whose weight one worker remembers; beyond it the memory starts anew.
REMEMBERED = 100_000
TREES, DEPTH, SEED = 12, 3, 7
N_FEATURES = 14


def held_out(key: Column) -> Column:
    """Rows that learning never sees: the CRC-32 of the key as text is divisible by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def tokens_of(text: str) -> set[str]:
    """The distinct words of a text, and their starts marked by a tilde."""
    words = set(WORD.findall(text.lower()))
    return words | {w[:n] + "~" for n in STARTS for w in words if len(w) >= n}


@dataclass
class Lexicon:
    """Weights of words and word starts; a word weighs as much as its heaviest entry."""

    weights: dict[str, float]
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            starts = (self.weights.get(word[:n] + "~", 0.0) for n in STARTS if len(word) >= n)
            found = max(self.weights.get(word, 0.0), *starts, 0.0, 0.0)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = found
        return found

    def features(self, text: str) -> list[float]:
        low = text.lower()
        words = WORD.findall(low)
        n = max(1, len(words))
        weigh = self.weight
        heavy = [(i, w) for i, w in enumerate(map(weigh, words)) if w > 0]
        persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        near = 0
        if heavy and persons:
            at, places = np.array([i for i, _ in heavy]), np.array(persons)
            after = np.searchsorted(places, at - NEAR)
            near = int((places[np.minimum(after, len(places) - 1)] - at <= NEAR)[after < len(places)].sum())
        exact = sum(words[i] in self.weights for i, _ in heavy)
        disguised = [d for d in DISGUISED.findall(low)]
        unmasked = sum(weigh("".join(WORD.findall(d.translate(SIGNS)))) > 0 for d in disguised)
        letters = sum(map(len, words))
        chars = max(1, len(text))
        total = sum(w for _, w in heavy)
        return [
            math.log1p(len(words)),
            100 * exact / n,
            100 * (len(heavy) - exact) / n,
            total / n,
            max((w for _, w in heavy), default=0.0),
            math.log1p(len(heavy)),
            float(len({words[i] for i, _ in heavy})),
            100 * near / n,
            100 * len(persons) / n,
            sum(map(str.isupper, text)) / max(1, letters),
            len(PUNCTUATION.findall(text)) / chars,
            len(SHOUT.findall(text)) / chars,
            100 * len(disguised) / n,
            float(unmasked),
        ]


def feature_column(df: DataFrame, text: str, lexicon: Lexicon) -> Column:
    """All features of a text column, computed in Arrow batches."""
    ready_workers(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(lexicon.weights)
    own: list[Lexicon] = []

    def of(texts: pa.Array) -> pa.Array:
        if not own:
            own.append(Lexicon(shared.value))
        return pa.array([own[0].features(t.as_py() or "") for t in texts], pa.list_(pa.float64()))

    of.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(of, "array<double>")(col(text))


def token_counts(rows: DataFrame) -> DataFrame:
    """``token``, ``toxic`` and the number of texts with it; each task adds up its batches first."""
    schema = T.StructType([
        T.StructField("token", T.StringType()), T.StructField("toxic", T.LongType()), T.StructField("n", T.LongType())])
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "text"):
                counts: Counter = Counter()
                for text, toxic in zip(text_of(chunk, "text"), chunk.column("toxic").to_pylist(), strict=True):
                    counts.update((t, toxic) for t in tokens_of(text))
                if counts:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([t for t, _ in counts], pa.string()), pa.array([x for _, x in counts], pa.int64()),
                        pa.array(list(counts.values()), pa.int64())], schema=arrow)

    return rows.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(work, schema)


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Entries that are far more frequent in toxic texts, by the log ratio of smoothed shares."""
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    weights = {w: LEAST_RATIO for w in INSULTS}
    if bad and good:
        least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * bad))
        ratio = F.ln((F.col("bad") + 0.5) / (bad + 1.0)) - F.ln((F.col("good") + 0.5) / (good + 1.0))
        found = (
            token_counts(rows).groupBy("token")
            .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
                 F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good"))
            .where(F.col("bad") >= least).withColumn("ratio", F.round(ratio, 9)).where(F.col("ratio") >= LEAST_RATIO)
            .orderBy(F.desc("ratio"), "token").limit(MOST_ENTRIES).collect()
        )
        weights |= {r["token"]: r["ratio"] for r in found}
    return Lexicon(weights)


@dataclass
class Toxicity:
    """What was learned: the lexicon, the trees and the calibration, or a constant share."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    share: float = 0.0

    def score(self, df: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
        """Add the calibrated score (0 to 1) of every row."""
        kept = df.drop(score)
        if self.trees is None:
            return kept.withColumn(score, F.lit(self.share))
        held = kept.select(F.struct(*map(col, kept.columns)).alias("row"), col(text).alias("text"))
        measured = held.select("row", array_to_vector(feature_column(held, "text", self.lexicon)).alias("features"))
        return calibrated(self.trees, self.steps, measured).select("row.*", F.col("calibrated").alias(score))


def raw(trees: GBTClassificationModel, measured: DataFrame) -> DataFrame:
    return trees.transform(measured).withColumn("raw", vector_to_array("probability")[1]).drop(
        "rawPrediction", "probability", "prediction")


def calibrated(trees: GBTClassificationModel, steps: IsotonicRegressionModel, measured: DataFrame) -> DataFrame:
    found = steps.transform(raw(trees, measured))
    return found.withColumn("calibrated", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction"))))


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_rows: int = SAMPLE_ROWS) -> Toxicity:
    """Learn from labelled rows that are not held out, at most ``sample_rows`` of them."""
    marked = (
        labels.select(col(key).alias("id"), col(label).cast("int").alias("toxic")).where("id is not null and toxic is not null")
        .groupBy("id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")).where(~held_out(F.col("id")))
        .orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    )
    part = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(8))
    # one text for each label, however often a key is repeated and with how many texts
    first = F.min_by("text", F.xxhash64("text")).alias("text")
    rows = materialize(
        df.select(col(key).alias("id"), col(text).alias("text")).join(F.broadcast(marked), "id")
        .groupBy("id", "toxic").agg(first)
        .select("id", "text", "toxic", F.when(part < 3, "lexicon").when(part < 6, "trees").otherwise("steps").alias("part"))
    )
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Toxicity(Lexicon({}), None, None, float(1 in sizes))
    lexicon = learn_lexicon(rows.where("part = 'lexicon'"))
    measured = materialize(
        rows.where("part <> 'lexicon'").repartition(4, "id")
        .select("id", "toxic", "part", feature_column(rows, "text", lexicon).alias("values"))
    ).select("id", F.col("toxic").cast("double").alias("label"), "part", array_to_vector("values").alias("features"))

    def of_part(name: str) -> DataFrame:
        """The rows of one part, or of both where one lacks a class."""
        own = measured.where(F.col("part") == name)
        return own if own.select("label").distinct().count() == 2 else measured

    if measured.select("label").distinct().count() < 2:
        return Toxicity(lexicon, None, None, sizes[1] / sum(sizes.values()))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64, stepSize=0.3).fit(of_part("trees"))
    steps = IsotonicRegression(featuresCol="raw").fit(raw(trees, of_part("steps")).select("raw", "label"))
    return Toxicity(lexicon, trees, steps)


def score_table(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``held_out``, ``score`` and ``predicted`` of every row."""
    model = fit(df, labels, key, text)
    scored = model.score(df.select(col(key), col(text)), text)
    return scored.select(
        col(key), held_out(col(key)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def reject(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with a score below 0.5."""
    score = fresh(df, "score")
    return fit(df, labels, key, text).score(df, text, score).where(col(score) < 0.5).drop(score)
