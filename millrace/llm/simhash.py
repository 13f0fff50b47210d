"""SimHash near-duplicates: fingerprints, links by a generalised pigeonhole search, and components.

The 64 bits are grouped into partitions of correlated bits, and every partition gets a threshold of its
own. If the thresholds add up to ``distance - partitions + 1``, two fingerprints within ``distance`` are
within the threshold of at least one partition (a threshold of -1 leaves a partition out). How many
partitions there are and what threshold each gets is chosen by dynamic programming on the estimated
numbers of probes and candidates, which come from the number of distinct fingerprints and a bounded
sample of them; the estimates steer cost only, never a result. Every fingerprint is entered under its
own value of a partition and probes all values within the threshold; pairs are verified in the join
itself, so that only true links leave it. Equal fingerprints are one node, so copies are never paired.

Defined results: null and empty texts, and texts without a word, have fingerprint zero and are linked
like any other; texts with fewer words than a shingle are one shingle. Rows are worked on one by one:
repeated rows are repeated in the result. A null id never names a component that has another id.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.frames import col, fresh, ready_workers, without
from millrace.session import materialize, settle

BITS = 64
DISTANCE = 3
WORDS = 3
#: Fixed value: the seed of the shingle hash.
SEED = 42
#: Distinct fingerprints that the cost estimate looks at.
SAMPLE_ROWS = 2_048
#: Cost of writing one probe, and of comparing one candidate.
PROBE_COST, CANDIDATE_COST = 4.0, 1.0
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint as a signed number: a bit is set if it is set in over half of the shingle hashes."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) <= words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, max(1, len(found) - words + 1))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        octets = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_column(df: DataFrame, text: str, words: int = WORDS) -> Column:
    """The fingerprint of a text column, computed in Arrow batches."""
    ready_workers(df.sparkSession)

    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), words) for t in texts], pa.int64())

    of.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(of, "long")(col(text))


def hex_digits(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), 16, "0"))


@dataclass(frozen=True)
class Partition:
    """A set of bits, and how many of them may differ."""

    bits: tuple[int, ...]
    threshold: int

    def mask(self) -> int:
        return signed(sum(1 << b for b in self.bits))

    def flips(self) -> list[int]:
        """All changes of at most ``threshold`` bits, the empty one first."""
        chosen = (c for n in range(self.threshold + 1) for c in combinations(self.bits, n))
        return [signed(sum(1 << b for b in c)) for c in chosen]


def signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def correlated_groups(bits: np.ndarray, groups: int) -> list[tuple[int, ...]]:
    """The bits in equal groups: each starts at the bit most tied to the rest and takes the nearest ones."""
    width = bits.shape[1]
    with np.errstate(invalid="ignore", divide="ignore"):
        tie = np.abs(np.nan_to_num(np.corrcoef(bits, rowvar=False))) if len(bits) > 1 else np.eye(width)
    left, found = np.ones(width, bool), []
    for g in range(groups):
        size = int(left.sum()) // (groups - g)
        near = tie @ left
        group: list[int] = []
        while len(group) < size:
            group.append(int(np.argmax(np.where(left, near, -1.0))))
            near = tie[:, group].sum(1)
            left[group[-1]] = False
        found.append(tuple(sorted(group)))
    return found


def within_shares(bits: np.ndarray, group: tuple[int, ...], most: int) -> list[float]:
    """The share of pairs that differ in at most 0, 1, … ``most`` bits of the group: as seen in the sample,
    or as independent bits would give it, whichever is larger."""
    one = bits[:, list(group)].mean(0) if len(bits) else np.full(len(group), 0.5)
    differ = 2 * one * (1 - one)
    chance = np.zeros(most + 2)
    chance[0] = 1.0
    for d in differ:
        chance[1:] = chance[1:] * (1 - d) + chance[:-1] * d
        chance[0] *= 1 - d
    free = np.cumsum(chance[: most + 1])
    part = bits[:, list(group)].astype(np.float32)
    if len(part) < 2:
        return free.tolist()
    ones = part.sum(1)
    apart = ones[:, None] + ones[None, :] - 2 * part @ part.T
    pairs = apart[np.triu_indices(len(part), 1)]
    seen = np.array([(pairs <= t + 0.5).mean() for t in range(most + 1)])
    return np.maximum(free, seen).tolist()


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 that add up to ``total`` at the least cost; ``costs[i][t + 1]`` is that of t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, extra in enumerate(row, start=-1):
                if spent + t not in after or cost + extra < after[spent + t][0]:
                    after[spent + t] = (cost + extra, [*chosen, t])
        best = after
    return best[total]


def plan(bits: np.ndarray, distinct: int, distance: int = DISTANCE) -> list[Partition]:
    """The partitions and thresholds of the least estimated cost for this many distinct fingerprints."""
    if not len(bits):
        bits = np.zeros((1, BITS), np.uint8)
    options, distinct = [], max(1, distinct)
    for count in range(1, distance + 3):
        groups = correlated_groups(bits, count)
        costs = []
        for group in groups:
            shares = within_shares(bits, group, distance)
            probes = np.cumsum([comb(len(group), t) for t in range(distance + 1)]) * distinct * PROBE_COST
            pairs = np.array(shares) * distinct * distinct / 2 * CANDIDATE_COST
            costs.append([0.0, *(probes + pairs).tolist()])
        cost, chosen = allocate(costs, distance - count + 1)
        options.append((cost, [Partition(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0]))
    return min(options, key=lambda o: o[0])[1]


def sample_bits(nodes: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """The bits of a bounded sample of the distinct fingerprints, chosen by hash."""
    found = nodes.select("fp", F.xxhash64("fp").alias("h")).orderBy("h").limit(rows).collect()
    numbers = np.array([r["fp"] for r in found], np.int64)
    return np.unpackbits(numbers.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def links(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints in column ``fp`` that differ in at most ``distance`` bits."""
    partitions = plan(sample_bits(nodes), nodes.count(), distance)

    def entry(i: int, p: Partition) -> Column:
        return F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(p.mask())).alias("value"))

    def probes(i: int, p: Partition) -> Column:
        flips = F.array(*(F.lit(f) for f in p.flips()))
        value = F.col("fp").bitwiseAND(F.lit(p.mask()))
        return F.transform(flips, lambda f: F.struct(F.lit(i).alias("part"), value.bitwiseXOR(f).alias("value")))

    entered = nodes.select(F.col("fp").alias("b"), F.explode(F.array(*(entry(i, p) for i, p in enumerate(partitions)))).alias("k"))
    asked = nodes.select(F.col("fp").alias("a"), F.explode(F.concat(*(probes(i, p) for i, p in enumerate(partitions)))).alias("k"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    pairs = asked.select("a", "k.part", "k.value").join(entered.select("b", "k.part", "k.value"), ["part", "value"])
    return pairs.where(near).select("a", "b")


def rooted_prints(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp``, ``least`` (its smallest id) and ``root`` (one fingerprint of its component) for ``id`` and ``fp``."""
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least")))
    ends = components(links(nodes, distance))
    return nodes.join(ends, nodes["fp"] == ends["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))


def classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp`` and ``component_id`` (the smallest id reachable) for a table of ``id`` and ``fp``."""
    rooted = rooted_prints(prints, distance)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                    distance: int = DISTANCE) -> DataFrame:
    """Per row: the key, the fingerprint as 16 hex digits, and the smallest key of its component."""
    prints = materialize(df.select(col(key).alias("id"), fingerprint_column(df, text, words).alias("fp")))
    found = classes(prints, distance)
    return prints.join(found, "fp").select(
        F.col("id").alias(key), hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def decisions(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``id, h, n, stays`` of all rows that are no longer single: those that go, and those that stay but are repeated.

    ``prints`` has ``id``, ``h`` (a hash of the text) and ``fp``. The row of the smallest id of a component stays, among
    equal ids that of the smallest hash, and one of several equal rows; rows without an id come last.
    """
    prints = materialize(prints)
    roots = rooted_prints(prints, distance).select("fp", "root")
    members = materialize(prints.groupBy("id", "h", "fp").agg(F.count("*").alias("n")).join(roots, "fp"))
    order = F.struct(F.col("id").isNull().alias("keyless"), "id", "h")
    # rows meet the chosen ones by their own key: a join by component would bring a hot one together
    chosen = members.groupBy("root").agg(F.min(order).alias("first")).select(
        F.col("first.id").alias("of_id"), F.col("first.h").alias("of_h"))
    own = F.col("id").eqNullSafe(F.col("of_id")) & F.col("h").eqNullSafe(F.col("of_h"))
    judged = members.join(chosen, own, "left").select("id", "h", "n", F.col("of_h").isNotNull().alias("stays"))
    return judged.where("n > 1 or not stays")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """The table with one row of each component; what decides on the way is deleted from the shared folder."""
    h = F.xxhash64(F.coalesce(col(text), F.lit("")))
    prints = df.select(col(key).alias("id"), h.alias("h"), fingerprint_column(df, text, words).alias("fp"))
    judged = settle(df.sparkSession, lambda: decisions(prints, distance))
    hashed = fresh(df, "text_hash")
    rest = without(df.withColumn(hashed, h), judged.where("not stays"), {key: "id", hashed: "h"})
    repeated = judged.where("stays").select("id", "h")
    if repeated.isEmpty():
        return rest.drop(hashed)
    single = without(rest, repeated, {key: "id", hashed: "h"})
    named = repeated.withColumnsRenamed({"id": "of_id", "h": "of_h"})
    held = rest.select(F.struct(*map(col, rest.columns)).alias("row")).join(
        named, F.col("row")[key].eqNullSafe(F.col("of_id")) & (F.col("row")[hashed] == F.col("of_h")), "left_semi")
    return single.unionByName(held.select("row.*").dropDuplicates([key, hashed])).drop(hashed)
