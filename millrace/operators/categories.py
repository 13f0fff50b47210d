"""Category cleaning, similarity, rare values, codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, present
from millrace.operators.base import Fitted, Step
from millrace.plans.counts import value_counts
from millrace.plans.sources import RowSource
from millrace.session import materialize

# Spellings of a missing category and of the two truth values, lower case, trimmed.
NULL_TOKENS = ("", "nan", "null", "n/a", "na", "none", "<na>", "nat", "-", "?")
TRUE_TOKENS = ("true", "yes", "y", "t", "1")
FALSE_TOKENS = ("false", "no", "n", "f", "0")

OTHER = "Other"
UNKNOWN_TOKEN = "__UNKNOWN__"


def _plain(value: Column) -> Column:
    return F.lower(F.trim(value))


def null_tokens(df: DataFrame, columns: list[str]) -> DataFrame:
    """Spellings of "missing" become NULL."""
    return df.withColumns(
        {c: F.when(~_plain(col(c)).isin(*NULL_TOKENS), col(c)) for c in present(df, columns)}
    )


def boolean_tokens(df: DataFrame, columns: list[str]) -> DataFrame:
    """Yes / no spellings become ``true`` / ``false``; every other text stays."""
    return df.withColumns(
        {
            c: F.when(_plain(col(c)).isin(*TRUE_TOKENS), "true")
            .when(_plain(col(c)).isin(*FALSE_TOKENS), "false")
            .otherwise(col(c))
            for c in present(df, columns)
        }
    )


def similarity(a: Column, b: Column) -> Column:
    """1 − edit distance ÷ longer length, ignoring case: 1 for equal texts, 0 for nothing in common."""
    x, y = F.lower(a), F.lower(b)
    longest = F.greatest(F.char_length(x), F.char_length(y))
    distance = F.levenshtein(x, y) / F.when(longest > 0, longest)
    return F.when(x == y, F.lit(1.0)).otherwise(F.lit(1.0) - distance)


@dataclass(frozen=True)
class CategorySettings:
    """``rare_threshold`` is the share below which a category is rare."""

    columns: tuple[str, ...]
    rare_threshold: float = 0.01
    similarity_threshold: float = 0.8
    auto_correct_typos: bool = True
    consolidate: bool = True

    def __post_init__(self):
        if not 0.0001 <= self.rare_threshold <= 1:
            raise ValueError("rare_threshold must lie between 0.0001 and 1")
        if not 0 < self.similarity_threshold <= 1:
            raise ValueError("similarity_threshold must lie between 0 and 1")


def shares(df: DataFrame, columns: list[str], counts: DataFrame | None = None) -> DataFrame:
    """``(column, value, n, total)`` for every distinct category, combined before the shuffle.

    ``counts`` are the value counts of the columns, where they have been taken already.
    """
    counts = value_counts(df, columns) if counts is None else counts
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column")


def frequent_categories(
    df: DataFrame, columns: list[str], threshold: float, counts: DataFrame | None = None
) -> dict[str, list[tuple]]:
    """Categories holding at least ``threshold`` of their column, most frequent first.

    There cannot be more than 1 / threshold of them per column, which bounds the driver list.
    """
    rows = shares(df, columns, counts).where(F.col("n") >= F.lit(threshold) * F.col("total")).collect()
    found: dict[str, list[tuple]] = {c: [] for c in columns}
    for row in sorted(rows, key=lambda r: (-r["n"], r["value"])):
        found[row["column"]].append((row["value"], row["n"]))
    return found


def closest_spelling(value: Column, n: Column, known: list[tuple], threshold: float) -> Column:
    """Struct ``(similarity, n, value)`` of the best known spelling that is more frequent, or NULL.

    Among equally similar spellings the more frequent wins, then the alphabetically first.
    """
    candidates = F.array(
        *(
            F.struct(F.lit(text).alias("correct"), F.lit(count).alias("count"), F.lit(-i).alias("rank"))
            for i, (text, count) in enumerate(known)
        )
    )
    length = F.char_length(value)

    def possible(c):
        other = F.char_length(c["correct"])
        near = F.abs(other - length) <= F.lit(1 - threshold + 1e-9) * F.greatest(other, length)
        return near & (c["count"] > n) & (c["correct"] != value)

    fitting = F.filter(
        F.transform(
            F.filter(candidates, possible),
            lambda c: F.struct(
                similarity(value, c["correct"]).alias("similarity"),
                c["rank"].alias("rank"),
                c["correct"].alias("correct"),
            ),
        ),
        lambda c: c["similarity"] >= F.lit(threshold),
    )
    return F.array_max(fitting)


def category_typos(df: DataFrame, settings: CategorySettings, counts: DataFrame | None = None) -> DataFrame:
    """``(column, wrong, correct, similarity)`` for spellings close to a more frequent category.

    The right spelling is a category that is not rare, so every distinct value is compared with a
    list of at most 1 / rare_threshold entries and no pairs of values are formed.
    """
    names = present(df, settings.columns)
    counts = materialize(value_counts(df, names)) if counts is None else counts
    known = frequent_categories(df, names, settings.rare_threshold, counts)
    best = F.lit(None)
    for name in names:
        if known[name]:
            hit = closest_spelling(
                F.col("value"), F.col("n"), known[name], settings.similarity_threshold
            )
            best = F.when(F.col("column") == F.lit(name), hit).otherwise(best)
    if not any(known.values()):
        best = F.lit(None).cast("struct<similarity: double, rank: int, correct: string>")
    return (
        counts.withColumn("best", best)
        .where(F.col("best").isNotNull())
        .select(
            "column",
            F.col("value").alias("wrong"),
            F.col("best.correct").alias("correct"),
            F.col("best.similarity").alias("similarity"),
        )
    )


class CategoryModel(Fitted):
    """``state[column]``: the frequent categories in training."""

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        s, made = self.settings, {}
        for name in present(df, self.state):
            known = [tuple(k) for k in self.state[name]["known"]]
            value = col(name)
            is_known = value.isin([k for k, _ in known]) if known else F.lit(False)
            tail = F.lit(OTHER) if s.consolidate else value
            if s.auto_correct_typos and known:
                best = closest_spelling(value, F.lit(0), known, s.similarity_threshold)
                tail = F.coalesce(best["correct"], tail)
            made[name] = F.when(value.isNull() | is_known, value).otherwise(tail)
        return made


class Categories(Step):
    """Rare spellings close to a frequent category become it; other rare ones become ``Other``.

    Frequent categories stay as they are, also when two of them look alike.
    """

    model = CategoryModel

    def learns_from_summaries(self) -> bool:
        return True

    def summary_columns(self, df: DataFrame) -> tuple[list[str], list[str]]:
        return [], present(df, self.settings.columns)

    def learn(self, df: DataFrame, source=None) -> dict[str, dict]:
        names = present(df, self.settings.columns)
        counts = (source or RowSource(df)).counts(names)
        known = frequent_categories(df, names, self.settings.rare_threshold, counts)
        return {c: {"known": [list(k) for k in known[c]]} for c in names}


def category_report(df: DataFrame, settings: CategorySettings) -> DataFrame:
    """Per column: categories, rare ones, typos, most frequent and its share. The columns are counted once."""
    names = present(df, settings.columns)
    counts = materialize(value_counts(df, names))
    typos = category_typos(df, settings, counts).groupBy("column").agg(F.count(F.lit(1)).alias("typos"))
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col("value"))).alias("best")
    rare = F.count_if(F.col("n") < F.lit(settings.rare_threshold) * F.col("total"))
    summary = (
        shares(df, names, counts)
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("categories"),
            rare.alias("rare"),
            best,
            F.max(F.col("n") / F.col("total")).alias("top_share"),
        )
    )
    return summary.join(typos, "column", "left").select(
        "column",
        "categories",
        "rare",
        F.coalesce("typos", F.lit(0).cast("long")).alias("typos"),
        F.col("best.value").alias("top_value"),
        "top_share",
    )


# Keys under which rows that need no code from the large table are spread over its join.
SPREAD = 4096


@dataclass(frozen=True)
class EncodeSettings:
    """Columns with up to ``driver_limit`` categories are mapped by a broadcast list; of larger ones
    only the frequent categories are, and the tail by a shuffled join."""

    columns: tuple[str, ...]
    handle_unknown: str = "ignore"
    unknown_token: str = UNKNOWN_TOKEN
    driver_limit: int = 2_000

    def __post_init__(self):
        if self.handle_unknown not in ("ignore", "error"):
            raise ValueError("handle_unknown must be 'ignore' or 'error'")


def _numbered(values: DataFrame) -> DataFrame:
    """Codes 0, 1, 2, … in ascending order of ``value`` without sorting in one task: a range
    partitioning gives ordered parts, and the sizes of the parts give the first code of each."""
    ordered = values.repartitionByRange("value").sortWithinPartitions("value")
    placed = materialize(ordered.withColumn("place", F.monotonically_increasing_id()))
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit(2**33 - 1))
    sizes = placed.groupBy(part.alias("part")).count().collect()
    starts, start = [], 0
    for row in sorted(sizes):
        starts.append((row["part"], start))
        start += row["count"]
    lookup = values.sparkSession.createDataFrame(starts, "part long, start long")
    joined = placed.withColumn("part", part).join(F.broadcast(lookup), "part")
    return joined.select("value", (F.col("start") + within).alias("code"))


class EncodeModel(Fitted):
    """``state[column]``: the ordered categories, or the path of a code table for large columns."""

    def _lookup(self, df: DataFrame, name: str, back: bool) -> tuple[DataFrame, DataFrame | None]:
        """A short list of (value, code) pairs to broadcast, and the full table if there is more.

        The list has at most ``driver_limit`` rows: all categories of a small column, or the most
        frequent ones of a large column.
        """
        state = self.state[name]
        if "categories" in state:
            pairs, table = [(v, i) for i, v in enumerate(state["categories"])], None
        else:
            pairs = [tuple(pair) for pair in state["hot"]]
            table = df.sparkSession.read.parquet(state["table"])
        if back:
            pairs.append((self.settings.unknown_token, state["size"]))
        short = df.sparkSession.createDataFrame(pairs, "value string, code long")
        return short, table

    def _map(self, df: DataFrame, name: str, back: bool = False) -> DataFrame:
        source, target = ("code", "value") if back else ("value", "code")
        short, table = self._lookup(df, name, back)

        def joined(rows: DataFrame, codes: DataFrame, out: str) -> DataFrame:
            renamed = codes.select(F.col(source).alias("__key"), F.col(target).alias(out))
            return rows.join(renamed, col(name) == F.col("__key"), "left").drop("__key")

        found = joined(df, F.broadcast(short), "__found")
        if table is not None:
            # Settled rows keep their place in the join under keys that match nothing and are many, so
            # neither a frequent value nor NULL is a hot key, and the source is read once.
            spread = F.monotonically_increasing_id() % SPREAD
            nothing = -1 - spread if back else F.concat(F.lit("\0"), spread.cast("string"))
            settled = F.col("__found").isNotNull() | col(name).isNull()
            key = F.when(settled, nothing).otherwise(col(name))
            codes = table.select(F.col(source).alias("__match"), F.col(target).alias("__late"))
            found = found.withColumn("__key", key).join(codes, F.col("__key") == F.col("__match"), "left")
            found = found.withColumn("__found", F.coalesce("__found", "__late")).drop("__key", "__match", "__late")
        if back:
            missing = F.lit(self.settings.unknown_token)
        elif self.settings.handle_unknown == "error":
            missing = F.raise_error(F.lit(f"{name}: unknown category")).cast("long")
        else:
            missing = F.lit(self.state[name]["size"]).cast("long")
        return found.withColumn(name, F.coalesce(F.col("__found"), missing)).drop("__found")

    def _transform(self, df: DataFrame) -> DataFrame:
        for name in present(df, self.state):
            df = self._map(df, name)
        return df

    def decode(self, df: DataFrame) -> DataFrame:
        """Codes back to text; the unknown code becomes the unknown token."""
        for name in present(df, self.state):
            df = self._map(df, name, back=True)
        return df


class Encode(Step):
    """Integer codes in alphabetical order; anything unseen or missing gets the next code after them."""

    model = EncodeModel

    def learn(self, df: DataFrame) -> dict[str, dict]:
        state, limit = {}, self.settings.driver_limit
        for name in present(df, self.settings.columns):
            counts = value_counts(df, [name]).select("value", "n")
            few = counts.select("value").limit(limit + 1).collect()
            if len(few) <= limit:
                values = sorted(r["value"] for r in few)
                state[name] = {"categories": values, "size": len(values)}
            else:
                state[name] = self._learn_large(counts, limit)
        return state

    @staticmethod
    def _learn_large(counts: DataFrame, limit: int) -> dict:
        counts = materialize(counts)
        codes = materialize(_numbered(counts.select("value")))
        total = counts.agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("size")).first()
        hot = counts.where(F.col("n") > F.lit(total["t"] / limit)).join(codes, "value")
        return {
            "table": codes.inputFiles()[0].rsplit("/", 1)[0],
            "size": total["size"],
            "hot": [[r["value"], r["code"]] for r in hot.collect()],
        }


# Embedding width up to each number of categories; the formula applies above.
EMBEDDING_WIDTHS = ((2, 1), (5, 3), (10, 4), (20, 6), (50, 8))


def embedding_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: categories, unique ratio, whether a full embedding pays, and the width to use
    (a light one of 1 or 2 where it does not)."""
    names = present(df, columns)
    sizes = value_counts(df, names).groupBy("column").agg(
        F.count(F.lit(1)).alias("categories"), F.sum("n").alias("rows")
    )
    n = F.col("categories")
    full = F.least(F.lit(50), F.floor(F.lit(1.6) * F.pow(n, F.lit(0.56))))
    for limit, size in reversed(EMBEDDING_WIDTHS):
        full = F.when(n <= limit, size).otherwise(full)
    light = F.greatest(F.lit(1), F.least(F.lit(2), F.floor(n / 20)))
    ratio = n / F.col("rows")
    pays = (n >= 2) & (ratio < 0.5)
    return sizes.select(
        "column",
        "categories",
        ratio.alias("unique_ratio"),
        pays.alias("use_embedding"),
        F.when(pays, full).otherwise(light).cast("int").alias("width"),
    )
