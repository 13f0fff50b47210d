"""Main text of web pages: site templates are found by counting element subtrees per host and deleted.

Pass one hashes the subtree of every element of a page (tag, class and all that stands in it). Spark counts,
per host, on how many pages with different main text each hash occurs; a subtree on at least ``MIN_PAGES``
of them is template. Counting different texts keeps copies of one article from passing for a template. Pass
two reads the pages again and deletes template subtrees, hidden elements, menus, footers, asides and comments. What is
marked as advert, notice, form and so on only by a name of its class, id or role, and a form, is in doubt: it goes
too, unless it holds most text of the page (a page may stand in one form, or in a box called notice) or, a form, prose
rather than fields. A name marks its element as a whole, or by its first or last part (``comments-area``,
``cookieBanner``, ``main-menu``), but not where that part says what a page has (``with-sidebar``). Nothing that is
or holds an article is deleted. What is left is the text: the blocks of the articles, or of the main element,
unless several times as much text that nothing doubts stands outside of them: then they are teasers.
Inside an article only containers are deleted as template: prose that several articles share stays.

A template is one number of eight bytes, made of host and subtree. The driver gathers and broadcasts these numbers
while there are at most ``PACKED_ROWS`` of them; beyond that they stay on the executors, and every page gets its own by
joins on hashes of pages that never broadcast a side.

Defined results: null or empty html, and pages without text, give an empty text. A null url is a host of its
own. Unclosed tags end with the element around them, an unclosed comment or script at the end of the page; a
reference that is not one stays as written. Repeated rows are repeated. Text is never cut.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.frames import col, fresh, ready_workers, text_chunks, text_of
from millrace.session import materialize

#: Pages of a host, with different main texts, that a subtree is on if it is template.
MIN_PAGES = 5
#: Template keys of eight bytes that the driver may gather and broadcast; more are joined.
PACKED_ROWS = 4_000_000

#: Elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var".split()
)
PROSE = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table caption thead tbody tfoot tr td th hr br".split())
NEVER_TEXT = frozenset(
    "head nav footer aside button select option datalist dialog menu noscript template svg canvas object audio video map".split()
)
#: Class, id and role names that mark what is not main text.
NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription paywall sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs footer topbar masthead toolbar pagination pager login signup contentinfo complementary dialog cookie-notice "
    "cookie-banner cookie-consent cookie-bar consent-banner gdpr-banner ad-slot ad-box ad-banner ad-container share-buttons "
    "social-links social-share related-posts related-articles search-form login-form skip-link role=search "
    "role=form role=alert".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
#: First or last parts of names that mark the same, and first parts that only tell what a page has.
PARTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr newsletter popup sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs footer topbar pagination".split()
)
HAVING = frozenset("with has have no not without show hide is js if wp body layout template".split())
#: Whole names that say as much as the tags of menus, footers and asides do.
STRUCTURE = frozenset(
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs footer pagination pager contentinfo complementary role=search role=form "
    "role=alert".split()
)
#: Fields of a form.
FIELDS = frozenset("input textarea select button".split())
#: The share of a page's text above which a doubtful element is the page itself; characters of text for each field
#: from which a form is prose; how many times as much text outside of articles makes them teasers.
MOST_TEXT, PROSE_PER_FIELD, TEASERS = 2 / 3, 200, 3
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+|[^\W\d_a-zA-Z]+")
#: An open element that a new one of these ends.
P_ENDERS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "body": ("head",),
}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b")


@lru_cache(maxsize=4096)
def marks_of(name: str) -> frozenset:
    """The name in lower case, and its first and last part if they decide."""
    parts, found = [p.lower() for p in NAME_PARTS.findall(name[:200])], {name.lower()}
    if len(parts) > 1 and parts[0] not in HAVING:
        found |= {f"part={p}" for p in (parts[0], parts[-1]) if p in PARTS}
        found |= {p for p in (parts[0], parts[-1]) if p in COMMENTS}
    return frozenset(found)


def is_main(tag: str, names: frozenset) -> bool:
    """Whether an element is main text: articles may be comments."""
    return tag == "main" or (tag == "article" and not names & COMMENTS)


def is_hidden(name: str, value: str) -> bool:
    """Whether this attribute hides its element."""
    value = html.unescape(value).strip()
    return (
        (name == "hidden" and value not in ("false", "until-found")) or (name == "aria-hidden" and value == "true")
        or (name == "style" and NO_DISPLAY.search(value) is not None))


@dataclass(slots=True)
class Element:
    """An open element: what stood before it, and what its hash is made of."""

    tag: str
    names: frozenset
    hidden: bool
    blocks: int
    pieces: int
    in_main: bool
    fields: int
    holds_main: bool = False
    parts: list[bytes] = field(default_factory=list)


class Page:
    """One pass over a page. ``is_template`` tells of a subtree hash whether to delete it."""

    def __init__(self, is_template: Callable[[int], bool]):
        self.is_template = is_template
        self.blocks: list[str] = []
        self.pieces: list[str] = []
        self.open: list[Element] = []
        self.counts: dict[str, int] = {}
        self.hashes: set[int] = set()
        self.articles: list[tuple[int, int]] = []
        self.mains: list[tuple[int, int]] = []
        self.doubtful: list[tuple[int, int]] = []
        self.main_depth = self.fields = 0

    def read(self, text: str) -> tuple[str, set[int]]:
        """The main text and the hashes of the subtrees that may be template."""
        at, end = 0, len(text)
        while at < end:
            start = text.find("<", at)
            if start < 0:
                start = end
            if start > at:
                self.text(text[at:start])
            if start >= end:
                break
            at = self.markup(text, start)
        while self.open:
            self.close()
        self.flush()
        return "\n".join(self.chosen()), self.hashes

    def chosen(self) -> list[str]:
        """The blocks that are main text."""
        sizes, stays = [len(b) for b in self.blocks], [True] * len(self.blocks)
        doubted = [False] * len(self.blocks)
        before, total = [0, *accumulate(sizes)], sum(sizes)
        end = 0
        for low, high in sorted(self.doubtful, key=lambda r: (r[0], -r[1])):  # outer elements before inner ones
            doubted[low:high] = [True] * (high - low)
            if high > end and before[high] - before[low] <= MOST_TEXT * total:
                stays[low:high] = [False] * (high - low)
                end = high
        for ranges in (self.articles, self.mains):
            inside = [False] * len(self.blocks)
            for low, high in ranges:
                inside[low:high] = [True] * (high - low)
            own = [i for i, within in enumerate(inside) if within and stays[i]]
            if own:
                outside = [i for i, within in enumerate(inside) if not within and not doubted[i]]
                if sum(sizes[i] for i in outside) > TEASERS * sum(sizes[i] for i in own):
                    own = outside
                return [self.blocks[i] for i in own]
        return [b for b, stay in zip(self.blocks, stays, strict=True) if stay]

    def markup(self, text: str, start: int) -> int:
        """Handle what starts with this sign; the place behind it."""
        if text.startswith("<!--", start):
            stop = text.find("-->", start + 4)
            return len(text) if stop < 0 else stop + 3
        if text[start + 1 : start + 2] in ("!", "?"):
            stop = text.find(">", start)
            return len(text) if stop < 0 else stop + 1
        if not text[start + 1 : start + 3].lstrip("/")[:1].isalpha():
            self.text("<")
            return start + 1
        found = TAG.match(text, start)
        if not found:
            return len(text)
        tag = found[2].lower()
        if found[1]:
            self.end(tag)
        elif tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(text, found.end())
            if tag in ("xmp", "noembed"):
                self.text(text[found.end() : stop.start() if stop else len(text)])
            after = text.find(">", stop.start()) if stop else -1
            return len(text) if after < 0 else after + 1
        else:
            self.start(tag, found[3])
        return found.end()

    def text(self, raw: str) -> None:
        self.pieces.append(html.unescape(raw) if "&" in raw else raw)

    def flush(self) -> None:
        """End the current block."""
        if self.pieces:
            block = " ".join("".join(self.pieces).split())
            self.pieces.clear()
            if block:
                self.blocks.append(block)
                if self.open:
                    self.open[-1].parts.append(block.encode())

    def start(self, tag: str, marks: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
            return
        if tag not in INLINE:
            self.flush()
        if tag in P_ENDERS and self.counts.get("p"):
            self.end("p")
        enders = ENDS.get(tag, ())
        while self.open and self.open[-1].tag in enders:
            self.close()
        if tag in FIELDS and "hidden" not in marks.lower():
            self.fields += 1
        if tag in VOID:
            return
        names, hidden, label = frozenset(), False, tag.encode()
        given: set[str] = set()
        for name, *values in ATTRIBUTE.findall(marks) if marks else ():
            name, raw = name.lower(), "".join(values)
            value = raw.lower()
            if name in given:  # the first of several counts
                continue
            given.add(name)
            if name in ("class", "id", "role"):
                names = names.union(*map(marks_of, raw.split()))
                names |= frozenset(f"role={v}" for v in value.split()) if name == "role" else frozenset()
                label += f" {value}".encode() if name == "class" else b""
            else:
                hidden = hidden or is_hidden(name, value)
        element = Element(tag, names, hidden, len(self.blocks), len(self.pieces), self.main_depth > 0, self.fields)
        element.parts.append(label)
        self.open.append(element)
        self.counts[tag] = self.counts.get(tag, 0) + 1
        if is_main(tag, names):
            self.main_depth += 1
            for outer in reversed(self.open[:-1]):
                if outer.holds_main:
                    break
                outer.holds_main = True

    def end(self, tag: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
        if not self.counts.get(tag):
            if tag == "p":  # stands for an empty paragraph
                self.flush()
            return
        if tag in INLINE:  # an inline end tag doesn't reach out of its block
            for element in reversed(self.open):
                if element.tag == tag:
                    break
                if element.tag not in INLINE:
                    return
        else:
            self.flush_inline()
        while self.open and self.open[-1].tag != tag:
            self.close()
        if self.open:
            self.close()

    def flush_inline(self) -> None:
        """Close inline elements at the end of a block, then the block itself."""
        while self.open and self.open[-1].tag in INLINE:
            self.close()
        self.flush()

    def close(self) -> None:
        """Close the innermost element; delete what it held if that is not main text."""
        element = self.open[-1]
        inline = element.tag in INLINE
        if not inline:
            self.flush()
        self.open.pop()
        self.counts[element.tag] -= 1
        if inline:
            own = "".join(self.pieces[element.pieces :])
            element.parts.append(" ".join(own.split()).encode())
        digest = xxhash.xxh64_intdigest(b"\0".join(element.parts))
        filled = len(element.parts) > 1 and any(element.parts[1:])
        if self.open and not inline:
            self.open[-1].parts.append(digest.to_bytes(8, "little"))
        main = is_main(element.tag, element.names)
        deleted = self.unwanted(element)
        if not main and not element.holds_main and element.tag not in ("html", "body") and filled:
            if not (element.in_main and element.tag in PROSE):
                signed = digest - (1 << 64) if digest >> 63 else digest
                self.hashes.add(signed)
                deleted = deleted or self.is_template(signed)
        if deleted:
            del self.blocks[element.blocks :]
            del self.pieces[element.pieces :]
            for ranges in (self.articles, self.mains, self.doubtful):
                while ranges and ranges[-1][0] >= len(self.blocks):
                    ranges.pop()
        elif len(self.blocks) > element.blocks and self.in_doubt(element):
            self.doubtful.append((element.blocks, len(self.blocks)))
        if main:
            self.main_depth -= 1
            ranges = self.articles if element.tag == "article" else self.mains
            while ranges and ranges[-1][0] >= element.blocks:
                ranges.pop()
            if len(self.blocks) > element.blocks:
                ranges.append((element.blocks, len(self.blocks)))

    def unwanted(self, element: Element) -> bool:
        """Whether tag and names say that this is not main text."""
        if element.hidden:
            return element.tag not in ("html", "body")
        if element.holds_main or element.tag in ("html", "body") or is_main(element.tag, element.names):
            return False
        if element.names & COMMENTS or element.tag in NEVER_TEXT or (element.tag == "header" and not element.in_main):
            return True
        return bool(element.names & STRUCTURE) or (element.tag in INLINE and self.is_named(element))

    @staticmethod
    def is_named(element: Element) -> bool:
        return bool(element.names & NAMES) or any(n.startswith("part=") for n in element.names)

    def in_doubt(self, element: Element) -> bool:
        """Whether only a name, or being a form, says that this is not main text."""
        if element.holds_main or element.tag in ("html", "body") or is_main(element.tag, element.names):
            return False
        if element.tag == "form":
            size = sum(map(len, self.blocks[element.blocks :]))
            return size < PROSE_PER_FIELD * (self.fields - element.fields + 1) or self.is_named(element)
        return self.is_named(element)


def main_text(page: str | None, is_template: Callable[[int], bool] = lambda _: False) -> tuple[str, set[int]]:
    return Page(is_template).read(page or "")


def host_of(url: Column) -> Column:
    """The host of a url in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


SUBTREES = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("main_hash", T.LongType()), T.StructField("subtree", T.LongType())])


def subtrees(pages: DataFrame, url: str, page: str) -> DataFrame:
    """``host``, ``main_hash`` and ``subtree`` of every different subtree of every page."""
    ready_workers(pages.sparkSession)
    arrow = to_arrow_schema(SUBTREES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in text_chunks(batch, "page"):
                hashes, mains = [], []
                for page_text in text_of(chunk, "page"):
                    text, found = main_text(page_text)
                    hashes.append(np.fromiter(found, np.int64, len(found)))
                    mains.append(xxhash.xxh64_intdigest(text.encode()) >> 1)
                counts = np.array([len(h) for h in hashes], np.int64)
                rows = pa.array(np.repeat(np.arange(len(hashes)), counts))
                yield pa.RecordBatch.from_arrays([
                    chunk.column("host").take(rows), pa.array(np.repeat(np.array(mains, np.int64), counts)),
                    pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64)),
                ], schema=arrow)

    return pages.select(host_of(col(url)).alias("host"), col(page).alias("page")).mapInArrow(work, SUBTREES)


def template_key(host: Column, subtree: Column) -> Column:
    """One number for a subtree of a host."""
    return F.xxhash64(host).bitwiseXOR(subtree)


def templates(pages: DataFrame, url: str = "url", page: str = "html", min_pages: int = MIN_PAGES) -> DataFrame:
    """``host`` and ``subtree`` of all subtrees on at least ``min_pages`` pages of different main text."""
    return (
        subtrees(pages, url, page).distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages).select("host", "subtree")
    )


def packed(keys: DataFrame) -> np.ndarray:
    """The numbers of the only column in order, eight bytes each on the driver, without an object for each row."""
    found = keys.toArrow().column(0).to_numpy()
    return np.sort(found)


def among(keys: np.ndarray, host: int) -> Callable[[int], bool]:
    """Tells of a subtree hash whether it is a template of the host with this hash; ``keys`` are in order."""

    def is_template(subtree: int) -> bool:
        key = subtree ^ host
        at = keys.searchsorted(key)
        return bool(at < len(keys) and keys[at] == key)

    return is_template


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", min_pages: int = MIN_PAGES,
            broadcast_rows: int = PACKED_ROWS) -> DataFrame:
    """Per page: key, url, ``text`` and its code points ``n_chars``."""
    ready_workers(pages.sparkSession)
    found = materialize(templates(pages, url, page, min_pages).select(template_key(F.col("host"), F.col("subtree")).alias("template")))
    source = pages.select(col(key), col(url), F.xxhash64(host_of(col(url))).alias(fresh(pages, "host")), col(page).alias(fresh(pages, "page")))
    source = source.toDF("key", "url", "host", "page")
    if found.count() <= broadcast_rows:
        shared = pages.sparkSession.sparkContext.broadcast(packed(found))

        def text_with(pages: pa.Array, hosts: pa.Array) -> pa.Array:
            keys = shared.value
            return pa.array([
                main_text(p.as_py(), among(keys, h.as_py()))[0] for p, h in zip(pages, hosts, strict=True)
            ], pa.string())

        text_with.__annotations__ = {"pages": pa.Array, "hosts": pa.Array, "return": pa.Array}
        texts = source.select("key", "url", F.arrow_udf(text_with, "string")("page", "host").alias("text"))
    else:
        texts = _by_join(source, found)
    return texts.select(col("key").alias(key), col("url").alias(url), "text", F.char_length("text").cast("long").alias("n_chars"))


def _by_join(source: DataFrame, found: DataFrame) -> DataFrame:
    """Each page gets its own template keys by joins; a hot host is split by its subtrees and by pages.

    Both joins are hinted: written small, a table of keys looks small enough to broadcast, but for all its salts
    it is far too large for the driver.
    """
    keyed = source.withColumn("row", F.xxhash64("key", "url", "page"))

    def own_keys(pages: pa.Array, hosts: pa.Array) -> pa.Array:
        return pa.array([
            sorted(s ^ h.as_py() for s in main_text(p.as_py())[1]) for p, h in zip(pages, hosts, strict=True)
        ], pa.list_(pa.int64()))

    own_keys.__annotations__ = {"pages": pa.Array, "hosts": pa.Array, "return": pa.Array}

    def text_without(pages: pa.Array, hosts: pa.Array, own: pa.Array) -> pa.Array:
        texts = []
        for p, h, o in zip(pages, hosts, own, strict=True):
            host = h.as_py()
            texts.append(main_text(p.as_py(), {k ^ host for k in o.as_py() or ()}.__contains__)[0])
        return pa.array(texts, pa.string())

    text_without.__annotations__ = {"pages": pa.Array, "hosts": pa.Array, "own": pa.Array, "return": pa.Array}
    salts = 16
    held = keyed.select("row", F.explode(F.arrow_udf(own_keys, "array<long>")("page", "host")).alias("template"))
    salted = held.distinct().withColumn("salt", F.pmod("row", F.lit(salts)))
    spread = found.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    own = salted.hint("merge").join(spread, ["template", "salt"]).groupBy("row").agg(F.collect_set("template").alias("own"))
    joined = keyed.hint("merge").join(own, "row", "left")
    return joined.select("key", "url", F.arrow_udf(text_without, "string")("page", "host", "own").alias("text"))
