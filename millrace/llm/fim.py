"""Fill-in-middle transformation: a document is cut at two places and written prefix-suffix-middle or
suffix-prefix-middle, so that a model learns to fill gaps.

The places come from repeated-capture matching: one ``fullmatch`` of ``(unit)*`` with the ``regex`` library
retains every repetition, so ``match.ends(1)`` gives at once the number of units and where each of them
ends. A text of more than ``MOST_UNITS`` units is matched in runs of that many, the same pattern with an
upper count, so that the memory of a task stays bounded; the runs that hold the cuts are matched again
for their ends. What the document's own numbers decide (form and cuts) is drawn from a hash of its
key, so a lost executor that is run anew gives the same rows. Python returns four numbers per text; texts
are cut, joined and digested by built-in functions.

Defined results: null texts count as empty ones; empty texts, texts that hold a sentinel, and the share
of documents the hash leaves out are ``plain``, with null cuts and the text itself as output. Repeated
keys get the same draws, a null key those of an empty one. Rows are worked on one by one; columns of the
input that are named like a new one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import col, ready_workers

#: One code point.
UNIT = r"(?s:.)"
#: Units that one match retains at most; about 40 bytes each.
MOST_UNITS = 1 << 18


@dataclass(frozen=True)
class FimSettings:
    """Sentinels, the percentage of documents that are transformed, that of those written suffix first,
    the salt of the draws, and the pattern of a unit. Units must follow each other without gaps."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    transformed: int = 90
    suffix_first: int = 20
    salt: str = "1:"
    unit: str = UNIT

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or any(a in b for a in marks for b in marks if a != b) or "" in marks:
            raise ValueError("sentinels must be three texts of which none holds another")
        if any(a[-n:] == b[:n] for a in marks for b in marks for n in range(1, min(len(a), len(b)))):
            raise ValueError("the end of a sentinel must not be the start of one, else outputs can't be read back")
        if not (0 <= self.transformed <= 100 and 0 <= self.suffix_first <= 100):
            raise ValueError("shares are percentages")


def draw(key: Column, salt: str, place: int) -> Column:
    """The unsigned number in the given eight hex digits of the hash of salt and key."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("long")


class UnitCutter:
    """Finds the ends of units by matches that retain every repetition of the unit."""

    def __init__(self, unit: str = UNIT, most: int = MOST_UNITS):
        self.all = regex.compile(f"(?:({unit}))*")
        self.run = regex.compile(f"(?:({unit})){{1,{most}}}+")
        self.most = most

    def _ends(self, match) -> list[int]:
        return match.ends(1)

    def cuts(self, text: str, first: int, second: int) -> tuple[int, int, int]:
        """The number of units, and the offsets behind ``first % (n + 1)`` and ``second % (n + 1)`` units."""
        if len(text) <= self.most:
            match = self.all.fullmatch(text)
            if match is None:
                raise ValueError("units leave gaps in the text")
            ends = [0, *self._ends(match)]
            n = len(ends) - 1
            return n, ends[first % (n + 1)], ends[second % (n + 1)]
        starts, n = [], 0  # where each run of units starts, and how many units come before it
        at = 0
        while at < len(text):
            match = self.run.match(text, at)
            if match is None or match.end() == at:
                raise ValueError("units leave gaps in the text")
            starts.append((n, at))
            n += len(self._ends(match))
            at = match.end()
        starts.append((n, at))
        return n, self._offset(text, starts, first % (n + 1)), self._offset(text, starts, second % (n + 1))

    def _offset(self, text: str, starts: list[tuple[int, int]], units: int) -> int:
        """The offset behind so many units: the run that holds it is matched once more."""
        before, at = max(s for s in starts if s[0] <= units)
        return at if units == before else self._ends(self.run.match(text, at))[units - before - 1]


def cut_column(df: DataFrame, text: str, first: Column, second: Column, unit: str, most: int = MOST_UNITS) -> Column:
    """Per text: units, and the code points before the smaller and the larger cut."""
    ready_workers(df.sparkSession)

    def of(texts: pa.Array, firsts: pa.Array, seconds: pa.Array) -> pa.Array:
        cutter, found = UnitCutter(unit, most), []
        for t, a, b in zip(texts, firsts.to_pylist(), seconds.to_pylist(), strict=True):
            n, x, y = cutter.cuts(t.as_py() or "", a, b)
            found.append({"n": n, "low": min(x, y), "high": max(x, y)})
        return pa.array(found, pa.struct([("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]))

    of.__annotations__ = {"texts": pa.Array, "firsts": pa.Array, "seconds": pa.Array, "return": pa.Array}
    return F.arrow_udf(of, "n long, low long, high long")(col(text), first, second)


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", settings: FimSettings | None = None,
              output: str = "output", most: int = MOST_UNITS) -> DataFrame:
    """The table with ``n`` (units), ``form``, ``prefix_chars`` and ``middle_chars`` (code points, null if plain)
    and the written text in ``output``."""
    s = settings or FimSettings()
    rows = df.select(F.struct(*map(col, df.columns)).alias("row"), col(key).alias("k"), F.coalesce(col(text), F.lit("")).alias("t"))
    rows = rows.withColumn("c", cut_column(rows, "t", draw(F.col("k"), s.salt, 0), draw(F.col("k"), s.salt, 1), s.unit, most))
    held = F.lit(False)
    for mark in (s.prefix, s.suffix, s.middle):
        held = held | F.col("t").contains(mark)
    plain = (F.col("t") == "") | held | (draw(F.col("k"), s.salt, 2) % 100 >= s.transformed)
    spm = draw(F.col("k"), s.salt, 3) % 100 < s.suffix_first
    rows = rows.withColumn("form", F.when(plain, "plain").when(spm, "spm").otherwise("psm"))

    def part(start: Column, length: Column) -> Column:
        return F.substring(F.col("t"), start.cast("int"), length.cast("int"))

    low, high = F.col("c.low"), F.col("c.high")
    prefix, middle = part(F.lit(1), low), part(low + 1, high - low)
    suffix = part(high + 1, F.length("t"))
    psm = F.concat(F.lit(s.prefix), prefix, F.lit(s.suffix), suffix, F.lit(s.middle), middle)
    spm = F.concat(F.lit(s.suffix), suffix, F.lit(s.prefix), prefix, F.lit(s.middle), middle)
    cut = F.col("form") != "plain"
    made = {
        "n": F.col("c.n"), "form": F.col("form"), "prefix_chars": F.when(cut, low), "middle_chars": F.when(cut, high - low),
        output: F.when(F.col("form") == "plain", F.col("t")).when(F.col("form") == "psm", psm).otherwise(spm),
    }
    new = {name.lower() for name in made}
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in new]
    return rows.select(*kept, *(column.alias(name) for name, column in made.items()))


def restore(output: Column, form: Column, settings: FimSettings | None = None) -> Column:
    """The text that an output was made from, read back from its sentinels alone."""
    s = settings or FimSettings()

    def between(start: str, end: str | None) -> Column:
        after = F.substring(output, F.locate(start, output) + len(start), F.length(output))
        return after if end is None else F.substring_index(after, end, 1)

    psm = F.concat(between(s.prefix, s.suffix), between(s.middle, None), between(s.suffix, s.middle))
    spm = F.concat(between(s.prefix, s.middle), between(s.middle, None), between(s.suffix, s.prefix))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
