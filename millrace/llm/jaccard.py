"""N-gram Jaccard join: which texts share so many of their distinct word n-grams that they count as one.

A text is the set of hashes of its n-grams; equal sets are one node. Sets are read in one global order,
rarer n-grams first (by a table of counts of fixed size; the order steers cost, never a result). If two
sets are similar enough, their first few elements in that order share at least ``c`` elements, where the
length of these prefixes follows from sizes and ``c`` alone. The join is size-aware:

* small sets enumerate all subsets of ``SUBSET`` elements of their prefix, and meet in equal subsets;
* large sets scan the inverted lists of the elements of their prefix, where all sets stand that are not
  too small for them.

The boundary is the size class at which the estimated cost of enumerating all sets below it and scanning
for all above it is least; both come from exact counts over all sets.

No key's members are paired with each other as they are, because one group of near copies may hold a
third of the table. In each round every key compares one member, chosen by hash, with all its others;
verified links are contracted to components, and that member leaves the key. Only pairs of different
components still count. When rounds stop paying, what is left is compared in blocks of each key. All
comparisons first bound the overlap, without loss, by sizes, places in the order, and the parity of
hashed elements; survivors are verified by the intersection of the whole sets, which are read again
for those few sets only. Any link between different sets is thus either verified or lies within one
component by other verified links.

Defined results: null and empty texts, and texts without words, have no n-grams, are linked with nothing and
are components of their own. Texts with fewer words than ``words`` are one n-gram. Repeated rows are
repeated in the result; a null key never names a component that has another key. N-grams are compared
by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.frames import BROADCAST_ROWS, col, ready_workers
from millrace.session import materialize, settle

#: Elements of an enumerated subset.
SUBSET = 2
#: Cells of the table of counts that orders the elements.
CELLS = 1 << 18
#: Parity bits of a set, in 64-bit numbers.
PARITY = 8
#: How many of these numbers are compared first.
FIRST_BITS = 2
#: Sets of more elements have a parity of ``WIDE`` more numbers.
WIDE_SIZE, WIDE = 1_024, 128
#: Sizes at which the boundary between small and large sets may lie.
BOUNDARIES = (0, 12, 16, 24, 32, 48, 64, 96, 128, 256)
#: Cost of writing one key, and of comparing one pair.
KEY_COST, PAIR_COST = 4.0, 1.0
#: One in so many elements has its list counted for the choice of the boundary.
LISTS_SEEN = 16
#: Bytes of one text that are split into words at once.
LONG_TEXT = 1 << 20
#: Rounds go on while the pairs left over exceed so many for each member, and fall by this share at least.
PAIRS_PER_MEMBER, WORTH = 8, 0.1
#: Members of a key that are compared with each other in one block.
BLOCK_ROWS = 1_000

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BITS = [f"p{i}" for i in range(PARITY)]


@dataclass(frozen=True)
class JaccardSettings:
    """N-grams of ``words`` words; sets are linked when ``100 * intersection >= percent * union``."""

    words: int = 3
    percent: int = 90

    def __post_init__(self):
        if self.words < 1 or not 50 <= self.percent <= 100:
            raise ValueError("n-grams have a word at least, and percent lies between 50 and 100")

    def overlap(self, sizes: Column) -> Column:
        """The least intersection of two linked sets, by the sum of their sizes."""
        return F.ceil(sizes.cast("double") * self.percent / (100 + self.percent) - 1e-9).cast("long")

    def probe(self, n: Column, c: int) -> Column:
        """Elements of the prefix in which a set shares ``c`` with a linked set that is not larger."""
        return n - F.ceil(n.cast("double") * self.percent / 100 - 1e-9).cast("long") + c

    def entered(self, n: Column, c: int) -> Column:
        """The same for a linked set that is not smaller."""
        return n - self.overlap(2 * n) + c


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * _A
    value = (value ^ (value >> np.uint64(27))) * _B
    return value ^ (value >> np.uint64(31))


def word_numbers(text: str | None) -> np.ndarray:
    """A hash of every word: what white space of ASCII parts, A-Z lower-cased."""
    content, start, found = (text or "").encode("utf-8", "surrogatepass").lower(), 0, []
    while start < len(content):
        end = content.find(b" ", start + LONG_TEXT) if len(content) - start > LONG_TEXT else -1
        words = content[start : end if end >= 0 else len(content)].split()
        found.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        start = end if end >= 0 else len(content)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def gram_set(text: str | None, words: int) -> np.ndarray:
    """The distinct hashes of the text's n-grams, sorted."""
    numbers = word_numbers(text)
    if not len(numbers):
        return numbers
    length = min(words, len(numbers))
    value = np.full(len(numbers) - length + 1, np.uint64(length))
    for i in range(length):
        value = _mixed(value + numbers[i : i + len(value)])
    return np.unique(value)


def cell_counts(df: DataFrame, text: str, settings: JaccardSettings, cells: int = CELLS) -> np.ndarray:
    """How many elements of all sets fall into each cell; every task sends one row per used cell."""
    ready_workers(df.sparkSession)
    words = settings.words

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(cells, np.int64), [], 0
        for batch in batches:
            for t in batch.column(0):
                held.append((gram_set(t.as_py(), words) & np.uint64(cells - 1)).astype(np.int32))
                size += len(held[-1])
                if size > 4 * cells:
                    total += np.bincount(np.concatenate(held), minlength=cells)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=cells)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["cell", "n"])

    counted = df.select(col(text)).mapInArrow(work, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.zeros(cells, np.int64)
    pairs = counted.toArrow()  # at most as many rows as cells
    total[pairs.column("cell").to_numpy()] = pairs.column("n").to_numpy()
    return total


def describe(df: DataFrame, key: str, text: str, counts: np.ndarray, settings: JaccardSettings) -> DataFrame:
    """Per row: ``id``, ``text_hash``, ``class`` (a digest of the set), its size ``n``, the parity numbers and the
    prefix, long enough for ``SUBSET`` common elements."""
    ready_workers(df.sparkSession)
    words, percent, mask = settings.words, settings.percent, np.uint64(len(counts) - 1)
    ranks = np.argsort(np.argsort(counts, kind="stable"), kind="stable").astype(np.int32)

    def of(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            elements = gram_set(t.as_py(), words)
            n = len(elements)
            length = n + (-n * percent) // 100 + SUBSET  # n - ceil(n * percent / 100) + SUBSET
            first = np.argsort(ranks[elements & mask], kind="stable")[:length]
            bits = np.bincount(elements >> np.uint64(55), minlength=64 * PARITY).astype(np.uint8) & 1
            parity = np.packbits(bits, bitorder="little").view(np.int64).tolist()
            row = {"class": hashlib.md5(elements.tobytes()).digest(), "n": n, "prefix": elements[first].view(np.int64), "wide": None}
            if n > WIDE_SIZE:
                wide = np.bincount((elements >> np.uint64(20)) % np.uint64(64 * WIDE), minlength=64 * WIDE).astype(np.uint8) & 1
                row["wide"] = np.packbits(wide, bitorder="little").view(np.int64)
            rows.append(row | dict(zip(_BITS, parity, strict=True)))
        fields = [("class", pa.binary()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64()))]
        return pa.array(rows, pa.struct(fields + [(b, pa.int64()) for b in _BITS]))

    of.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    kind = "class binary, n long, prefix array<long>, wide array<long>, " + ", ".join(f"{b} long" for b in _BITS)
    made = F.arrow_udf(of, kind)(col(text))
    rows = df.select(col(key).alias("id"), F.xxhash64(col(text)).alias("text_hash"), made.alias("d"))
    return rows.select("id", "text_hash", "d.*")


def boundary(nodes: DataFrame, settings: JaccardSettings) -> int:
    """The size up to which sets enumerate subsets: the one of the least estimated cost.

    Keys are counted over all sets; how long the lists are that a size class meets is counted for one element of
    ``LISTS_SEEN``, chosen by hash, over all sets.
    """
    kind = F.lit(0)
    for i, size in enumerate(BOUNDARIES):
        kind = F.when(F.col("n") > size, i).otherwise(kind)
    own = F.slice("prefix", 1, settings.probe(F.col("n"), 1).cast("int"))
    seen = F.filter(own, lambda x: F.pmod(F.xxhash64(x), F.lit(LISTS_SEEN)) == 0)
    listed = nodes.select(kind.alias("kind"), F.explode(seen).alias("key"))
    kinds = range(len(BOUNDARIES))
    lists = listed.groupBy("key").agg(F.count("*").alias("all"), *(F.count_if(F.col("kind") == i).alias(f"k{i}") for i in kinds))
    met = lists.agg(*(F.sum((F.col("all") - 1) * F.col(f"k{i}")).alias(f"k{i}") for i in kinds)).first()
    m = settings.probe(F.col("n"), SUBSET)
    sized = nodes.groupBy(kind.alias("kind")).agg(F.sum(m * (m - 1) / 2).alias("subsets"), F.sum(settings.probe(F.col("n"), 1)).alias("listed"))
    keys = {r["kind"]: (float(r["subsets"]), float(r["listed"])) for r in sized.collect()}
    costs = []
    for i in kinds:  # classes below i enumerate, the others scan
        small = sum(KEY_COST * keys.get(j, (0, 0))[0] for j in range(i))
        large = sum(KEY_COST * keys.get(j, (0, 0))[1] + PAIR_COST * LISTS_SEEN * float(met[f"k{j}"] or 0) for j in range(i, len(BOUNDARIES)))
        costs.append(small + large)
    return BOUNDARIES[int(np.argmin(costs))]


def keyed(nodes: DataFrame, most: int, settings: JaccardSettings) -> DataFrame:
    """``key, node, look``: subsets of the sets up to ``most`` elements, and list entries of the others and of those that
    these may be linked with. ``look`` holds the set's size, its place in the order, and whether larger sets find it
    under this key too."""
    n, prefix = F.col("n"), F.col("prefix")

    def entry(key: Column, place: Column, c: int) -> Column:
        enters = (place < settings.entered(n, c)).cast("long")
        look = F.shiftleft(n, 32).bitwiseOR(F.shiftleft(place.cast("long"), 1)).bitwiseOR(enters)
        return F.struct(key.alias("key"), look.alias("look"))

    def subsets(j: Column) -> Column:
        return F.transform(F.slice(prefix, 1, j), lambda x: entry(F.xxhash64(x, F.get(prefix, j)), j, SUBSET))

    last = F.least(F.size("prefix"), settings.probe(n, SUBSET).cast("int")) - 1
    small = nodes.where((n <= most) & (last >= 1)).select("node", "n", F.explode(F.flatten(F.transform(F.sequence(F.lit(1), last), subsets))).alias("k"))
    own = F.slice(prefix, 1, settings.probe(n, 1).cast("int"))
    reach = most * settings.percent // 100
    large = nodes.where(n >= reach).select("node", "n", F.explode(F.transform(own, lambda x, i: entry(x, i, 1))).alias("k"))
    return small.union(large).select("k.key", "node", "k.look")


def may_link(settings: JaccardSettings, a: str, b: str) -> Column:
    """Whether two members of a key, by their sizes and places in the order, can share enough: the smaller one must
    be entered, and what lies behind the common element must suffice."""
    def size(side: str) -> Column:
        return F.shiftright(F.col(f"{side}.look"), 32)

    def place(side: str) -> Column:
        return F.shiftright(F.col(f"{side}.look").bitwiseAND(F.lit((1 << 32) - 1)), 1)

    def enters(side: str) -> Column:
        return F.col(f"{side}.look").bitwiseAND(F.lit(1)) == 1

    need = settings.overlap(size(a) + size(b))
    behind = F.least(size(a) - place(a), size(b) - place(b))
    entered = F.when(size(a) < size(b), enters(a)).when(size(a) > size(b), enters(b)).otherwise(enters(a) | enters(b))
    return entered & (F.least(size(a), size(b)) >= need) & (F.least(place(a), place(b)) + behind >= need)


def near_parity(settings: JaccardSettings, a: str, b: str, bits: list[str]) -> Column:
    """Whether the parities differ in no more bits than linked sets of these sizes can have unshared elements."""
    differ = sum((F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in bits), F.lit(0))
    sizes = F.col(f"{a}.n") + F.col(f"{b}.n")
    return differ <= sizes - 2 * settings.overlap(sizes)


class _Sets:
    """Whole sets of nodes, read from their texts when they are first needed and kept as written tables."""

    def __init__(self, df: DataFrame, key: str, text: str, rows: DataFrame, settings: JaccardSettings):
        self.texts = df.select(col(key).alias("id"), col(text).alias("text"), F.xxhash64(col(text)).alias("text_hash"))
        self.rows, self.settings, self.tables = rows, settings, []
        self.repeated = not rows.groupBy("id", "text_hash").agg(F.count("*").alias("m")).where("m > 1").isEmpty()

    def of(self, pairs: DataFrame) -> DataFrame:
        """A table ``node, elements`` that holds all nodes of the pairs."""
        wanted = pairs.select("a").union(pairs.select("b")).toDF("node").distinct()
        for known in self.tables:
            wanted = wanted.join(known.select("node"), "node", "left_anti")
        wanted = materialize(wanted)
        number = wanted.count()
        if number:
            found = self.rows.join(wanted, self.rows["at"] == wanted["node"]).select("node", "id", "text_hash", "class")
            found = materialize(found).withColumnsRenamed({"id": "i", "text_hash": "h"})
            small = number <= BROADCAST_ROWS
            same = F.col("id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h"))
            read = self.texts.join(F.broadcast(found) if small else found, same)
            if self.repeated:  # of rows that are repeated as a whole, one is enough
                read = read.groupBy("node", "class").agg(F.first("text").alias("text"))
            words = self.settings.words

            def of(texts: pa.Array, digests: pa.Array) -> pa.Array:
                sets = [gram_set(t.as_py(), words) for t in texts]
                same = [hashlib.md5(s.tobytes()).digest() == d for s, d in zip(sets, digests.to_pylist(), strict=True)]
                return pa.array([s.view(np.int64) if ok else None for s, ok in zip(sets, same, strict=True)], pa.list_(pa.int64()))

            of.__annotations__ = {"texts": pa.Array, "digests": pa.Array, "return": pa.Array}
            made = read.select("node", F.arrow_udf(of, "array<long>")("text", "class").alias("elements"))
            self.tables.append(materialize(made.where("elements is not null")))
        out = self.tables[0] if self.tables else None
        for more in self.tables[1:]:
            out = out.union(more)
        return out


def verified(pairs: DataFrame, sets: _Sets, settings: JaccardSettings) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are similar enough."""
    pairs = materialize(pairs.select("a", "b").distinct())
    whole = sets.of(pairs)
    if whole is None:
        return pairs
    left = whole.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = whole.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")).cast("long"))
    union = F.size("x") + F.size("y") - F.col("common")
    return both.where(100 * F.col("common") >= settings.percent * union).select("a", "b")


def _with_parity(pairs: DataFrame, nodes: DataFrame, settings: JaccardSettings) -> DataFrame:
    """The pairs that their parities leave open: a few bits are compared first, so that little travels with most."""
    for bits in (_BITS[:FIRST_BITS], _BITS):
        looks = nodes.select("node", "n", *bits)
        both = pairs.join(looks.alias("l"), F.col("a") == F.col("l.node")).join(looks.alias("r"), F.col("b") == F.col("r.node"))
        large = F.least("l.n", "r.n") > WIDE_SIZE
        pairs = both.where(near_parity(settings, "l", "r", bits)).select("a", "b", large.alias("large"))
    # large sets fill the bits of all; the few pairs of them are compared by many more
    pairs = materialize(pairs)
    wide = nodes.where("wide is not null").select("node", "n", "wide")
    both = pairs.where("large").join(wide.alias("l"), F.col("a") == F.col("l.node")).join(wide.alias("r"), F.col("b") == F.col("r.node"))
    differ = F.aggregate(F.zip_with("l.wide", "r.wide", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    sizes = F.col("l.n") + F.col("r.n")
    near = both.where(differ <= sizes - 2 * settings.overlap(sizes)).select("a", "b")
    return pairs.where("not large").select("a", "b").union(near)


MEMBER = ["key", "node", "look"]


def _one_against_all(members: DataFrame, turn: int, settings: JaccardSettings) -> DataFrame:
    """Every member of a key with more than one component, beside the member that this round compares with all.

    ``m`` members are under the key; ``meets`` tells whether the two may be linked and are not in one component yet.
    Keys are counted by themselves first: most have one member, and nothing but the key travels for them.
    """
    several = members.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    shared = members.join(several, "key")
    # another member for each key: a set that has several keys in common with a group meets several of the group
    order = F.struct(F.xxhash64("key", "node", F.lit(turn)).alias("drawn"), F.col("node").alias("first"), "look", "component")
    chosen = shared.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min(order).alias("f"))
    chosen = chosen.where("low < high").select("key", "f.first", "f.look", "f.component")
    a, b = shared.alias("a"), chosen.alias("b")
    met = a.join(b, F.col("a.key") == F.col("b.key")).where(F.col("a.node") != F.col("b.first"))
    meets = (F.col("a.component") != F.col("b.component")) & may_link(settings, "a", "b")
    return met.select(*(F.col(f"a.{c}") for c in MEMBER), "b.first", "a.m", meets.alias("meets"))


def _open_pairs(members: DataFrame) -> int:
    """Pairs of different components under one key, counted without making them."""
    shares = members.groupBy("key", "component").agg(F.count("*").cast("double").alias("m"))
    sums = shares.groupBy("key").agg(F.sum("m").alias("s"), F.sum(F.col("m") * F.col("m")).alias("q"))
    return int(sums.agg(F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()[0] or 0)


def _left_over(members: DataFrame, nodes: DataFrame, settings: JaccardSettings) -> DataFrame:
    """Pairs of different components under one key that bounds leave open, by blocks of the large keys."""
    sizes = members.groupBy("key").agg(F.count("*").alias("m"), F.min("component").alias("low"), F.max("component").alias("high"))
    sizes = sizes.where("low < high").select("key", F.ceil(F.col("m") / BLOCK_ROWS).cast("int").alias("blocks"))
    cut = members.join(sizes, "key").join(nodes.select("node", "n", *_BITS), "node")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    places = F.sequence(F.lit(0), F.col("blocks") - 1)
    sent = cut.withColumn("other", F.explode(places)).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    a, b = sent.alias("a"), sent.alias("b")
    met = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("key", "i", "j")]
    # within a block all pairs once; between two blocks those of one with those of the other
    once = F.when(F.col("a.i") == F.col("a.j"), F.col("a.node") < F.col("b.node")).otherwise(F.col("a.block") < F.col("b.block"))
    apart = F.col("a.component") != F.col("b.component")
    pairs = a.join(b, [*met, once, apart, may_link(settings, "a", "b"), near_parity(settings, "a", "b", _BITS)])
    pairs = pairs.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()
    return _with_parity(pairs, nodes, settings)


def linked_components(df: DataFrame, key: str, text: str, rows: DataFrame, nodes: DataFrame, settings: JaccardSettings) -> DataFrame:
    """``node, component`` of all nodes with links: rounds of one against all, then the rest."""
    sets = _Sets(df, key, text, rows, settings)
    members = keyed(nodes, boundary(nodes, settings), settings).withColumn("component", F.col("node"))
    links = ends = None
    turn, before = 0, None
    while True:
        met = materialize(_one_against_all(members, turn, settings).where("meets or m > 2"))
        pairs = met.where("meets").select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()
        found = verified(_with_parity(pairs, nodes, settings), sets, settings)
        links = materialize(found if links is None else links.union(found))
        ends = components(links)
        # the compared member has left its key; keys of two are done
        known = ends.withColumnRenamed("node", "of")
        members = materialize(
            met.where("m > 2").select(*MEMBER).join(known, F.col("node") == F.col("of"), "left")
            .select(*MEMBER, F.coalesce("component", "node").alias("component")))
        pairs_left, turn = _open_pairs(members), turn + 1
        if not pairs_left:
            return ends
        if pairs_left <= PAIRS_PER_MEMBER * members.count() or (before is not None and pairs_left > (1 - WORTH) * before):
            rest = verified(_left_over(members, nodes, settings), sets, settings)
            return components(materialize(links.union(rest)))
        before = pairs_left


def join_components(df: DataFrame, key: str = "doc_id", text: str = "text", settings: JaccardSettings | None = None) -> DataFrame:
    """Per row: the key, ``n_shingles`` (the size of its set) and ``component_id`` (the smallest key it is linked
    with, directly or not, its own included)."""
    s = settings or JaccardSettings()
    described = describe(df, key, text, cell_counts(df, text, s), s)
    rows = materialize(described.withColumn("at", F.monotonically_increasing_id()))
    classes = materialize(rows.where("n > 0").groupBy("class").agg(F.min("at").alias("node"), F.min("id").alias("least")))
    chosen = classes.select(F.col("node").alias("at"))
    nodes = materialize(rows.join(chosen, "at", "left_semi").select(F.col("at").alias("node"), "n", "prefix", "wide", *_BITS))
    ends = settle(df.sparkSession, lambda: linked_components(df, key, text, rows, nodes, s))
    rooted = classes.join(ends, "node", "left").withColumn("root", F.coalesce("component", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(least, "root").select("class", "component_id")
    some = rows.where("n > 0").join(found, "class").select("id", F.col("n").alias("n_shingles"), "component_id")
    none = rows.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return some.union(none).withColumnRenamed("id", key)
