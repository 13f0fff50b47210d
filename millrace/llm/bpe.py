"""Byte-level BPE: encode texts by a rank file, decode ids, keep the byte offset of every token.

Texts are cut into pieces without a regular expression. Every code point gets a class from a table;
the class, with the two code points that follow, makes a symbol; and each symbol is a function from
automaton state to automaton state. Composition of such functions is associative, so a chunk is
scanned in blocks side by side: compose each block, combine the blocks by doubling, and replay every
block from its entry state. A piece starts wherever the replay says so. The distinct pieces of a chunk
go through a bounded cache of merged pairs; ids and offsets are gathered from it by array code.

Defined results: null and empty texts give no ids. A text of any length is cut at places where a piece
starts whatever stands around, so that a task holds one chunk at a time. Rows are worked on one by
one: repeated rows give repeated results. Columns named like the new ones are replaced.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.llm.frames import extended, lists, ragged, ready_workers, text_chunks, text_of, with_fields

#: The code points of white space.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
#: What may follow an apostrophe at the start of a piece and belongs to it.
SHORT_ENDINGS, LONG_ENDINGS = ("s", "t", "m", "d"), ("re", "ve", "ll")

OTHER, LETTER, NUMBER, WHITE, SPACE = range(5)
#: Symbols: a code point with what follows it. MID is white space with more white space (or the end)
#: behind it; JOIN the blank before a word, ALONE other white space before a word. FIRST is added at
#: the start of a text; IDLE fills up the last block.
SYM_LETTER, SYM_NUMBER, SYM_OTHER, SYM_SHORT, SYM_LONG, SYM_MID, SYM_JOIN, SYM_ALONE = range(8)
FIRST, IDLE = 8, 16
#: States: inside letters, numbers, others, white space; behind a joined blank; one or two letters of a
#: contraction to go; and a piece has just ended.
IN_LETTER, IN_NUMBER, IN_OTHER, IN_WHITE, JOINED, ONE_LEFT, TWO_LEFT, ENDED = range(8)
STATES = 8
BLOCK = 256
#: Pieces kept by one worker; beyond it the cache starts anew, which changes no result.
CACHED_PIECES = 150_000
#: Pieces up to this many bytes are merged side by side.
SHORT_PIECE = 32
NO_RANK = 1 << 40
#: Code points of one text that are scanned at once.
LONG_TEXT = 1 << 20


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece starts, by symbol * STATES + state."""
    follow = np.zeros((IDLE + 1, STATES), np.uint8)
    cut = np.ones((IDLE + 1, STATES), bool)
    plain = {
        SYM_LETTER: IN_LETTER, SYM_NUMBER: IN_NUMBER, SYM_OTHER: IN_OTHER, SYM_SHORT: ONE_LEFT,
        SYM_LONG: TWO_LEFT, SYM_MID: IN_WHITE, SYM_JOIN: JOINED, SYM_ALONE: IN_WHITE,
    }
    goes_on = [
        (SYM_LETTER, IN_LETTER, IN_LETTER), (SYM_LETTER, JOINED, IN_LETTER), (SYM_LETTER, TWO_LEFT, ONE_LEFT),
        (SYM_LETTER, ONE_LEFT, ENDED), (SYM_NUMBER, IN_NUMBER, IN_NUMBER), (SYM_NUMBER, JOINED, IN_NUMBER),
        (SYM_MID, IN_WHITE, IN_WHITE),
    ]
    goes_on += [(s, state, IN_OTHER) for s in (SYM_OTHER, SYM_SHORT, SYM_LONG) for state in (IN_OTHER, JOINED)]
    for symbol, state in plain.items():
        follow[symbol] = state
        follow[FIRST + symbol] = state
    for symbol, state, to in goes_on:
        follow[symbol, state], cut[symbol, state] = to, False
    follow[IDLE], cut[IDLE] = np.arange(STATES), False
    return follow.ravel(), cut.ravel()


FOLLOW, CUT = automaton()


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """The class of every code point, letters and numbers as the tokenizer library knows them."""
    import tiktoken

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    table = np.zeros(0x110000, np.uint8)
    single = {bytes([i]): i for i in range(256)}
    for name, code in (("L", LETTER), ("N", NUMBER)):
        found = tiktoken.Encoding(f"class-{name}", pat_str=rf"\p{{{name}}}", mergeable_ranks=single, special_tokens={})
        members = bytes(found.encode_ordinary(every)).decode()
        table[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = code
    table[list(WHITE_SPACE)] = WHITE
    table[32] = SPACE
    return table


def symbols(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The symbol of every code point; ``firsts`` are the places where a text starts."""
    kind = code_point_classes()[points]
    first = np.zeros(len(points) + 2, bool)
    first[firsts] = True
    first[len(points) :] = True
    white = kind >= WHITE
    word_next = np.append(~white[1:], False) & ~first[1:-1]
    symbol = np.array([SYM_OTHER, SYM_LETTER, SYM_NUMBER, SYM_ALONE, SYM_JOIN], np.uint8)[kind]
    symbol[white & ~word_next] = SYM_MID
    at = np.flatnonzero((points == ord("'")) & ~first[1:-1])
    if len(at):
        padded = np.append(points, [0, 0])
        one, two = padded[at + 1], padded[at + 2]
        symbol[at[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = SYM_SHORT
        long = np.zeros(len(at), bool)
        for a, b in LONG_ENDINGS:
            long |= (one == ord(a)) & (two == ord(b))
        symbol[at[long & ~first[at + 2]]] = SYM_LONG
    symbol[firsts] += FIRST
    return symbol


def piece_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where pieces start, by scanning the composed transition functions of blocks."""
    n = len(points)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, IDLE, np.uint8)
    padded[:n] = symbols(points, firsts)
    rows = padded.reshape(blocks, BLOCK).T.astype(np.int16) * STATES
    function = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))
    for row in rows:
        function = FOLLOW.take(row[:, None] + function)
    step = 1
    while step < blocks:
        function[step:] = np.take_along_axis(function[step:], function[:-step], axis=1)
        step *= 2
    state = np.append(np.uint8(ENDED), function[:-1, ENDED])
    cuts = np.empty((BLOCK, blocks), bool)
    for i, row in enumerate(rows):
        code = row + state
        cuts[i] = CUT.take(code)
        state = FOLLOW.take(code)
    return np.flatnonzero(cuts.T.ravel()[:n])


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: join the neighbours of the lowest rank, leftmost first, while any has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if gone[i] or end[i] >= n or end[end[i]] != stop or gone[end[i]]:
            continue
        right = end[i]
        gone[right], end[i] = True, stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        left = before[i]
        if left >= 0 and (r := ranks.get(piece[left:stop])) is not None:
            heapq.heappush(heap, (r, left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


class Coder:
    """Ranks, the bytes of every id, and the cached pieces of one worker."""

    def __init__(self, content: bytes):
        self.ranks = read_ranks(content)
        top = max(self.ranks.values(), default=-1) + 1
        self.length = np.zeros(top, np.int64)
        for token, rank in self.ranks.items():
            self.length[rank] = len(token)
        self.start = np.cumsum(self.length) - self.length
        by_rank = sorted(self.ranks, key=self.ranks.get)
        self.content = np.frombuffer(b"".join(by_rank), np.uint8)
        self.single = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.width = top + 1
        pairs = {
            self.ranks[token[:cut]] * self.width + self.ranks[token[cut:]]: rank
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ranks and token[cut:] in self.ranks
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)
        self.clear()

    def clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.ids = array("i")
        self.counts = array("q")

    def pieces(self, texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """The pieces of all texts, and how many each text has."""
        joined = "".join(texts)
        if not joined:
            return [], np.zeros(len(texts), np.int64)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        chars = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(chars)
        starts = piece_starts(points, np.unique((ends - chars)[chars > 0]))
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        at = (np.cumsum(width) - width)[starts].tolist()
        content = joined.encode()
        found = [content[a:b] for a, b in zip(at, [*at[1:], len(content)], strict=True)]
        return found, np.diff(np.searchsorted(starts, np.append(0, ends)))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of neighbours, NO_RANK where they do not join."""
        key = np.where((left < 0) | (right < 0), -1, left * self.width + right)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], NO_RANK)

    def merge_short(self, pieces: list[bytes]) -> list[list[int]]:
        """As ``merge_pairs``, for many short pieces side by side: one merge of each piece a round."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        wide = int(size.max()) + 1
        columns = np.arange(wide)
        token = np.full((len(pieces), wide), -1, np.int64)
        token[columns < size[:, None]] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full(token.shape, NO_RANK)
        rank[:, :-1] = self._rank(token[:, :-1], token[:, 1:])
        done, live = np.empty_like(token), np.arange(len(pieces))
        while len(live):
            at = rank.argmin(1)
            best = rank[np.arange(len(live)), at]
            going = best < NO_RANK
            if not going.all():
                done[live[~going]] = token[~going]
                token, rank, live, at, best = token[going], rank[going], live[going], at[going], best[going]
            rows = np.arange(len(live))
            source = np.minimum(columns + (columns > at[:, None]), wide - 1)
            token, rank = np.take_along_axis(token, source, 1), np.take_along_axis(rank, source, 1)
            token[rows, at] = best
            rank[rows, at] = self._rank(best, token[rows, at + 1])
            inner = np.flatnonzero(at)
            rank[inner, at[inner] - 1] = self._rank(token[inner, at[inner] - 1], best[inner])
        kept = done >= 0
        return [row[:n] for row, n in zip(done.tolist(), kept.sum(1).tolist(), strict=True)]

    def learn(self, pieces: set[bytes]) -> None:
        """Merge pieces that are not cached yet."""
        groups: dict[int, list[bytes]] = {}
        for piece in pieces:
            known = piece in self.ranks or len(piece) > SHORT_PIECE
            groups.setdefault(0 if known else -(-len(piece) // 8), []).append(piece)
        for group, members in groups.items():
            merged = self.merge_short(members) if group else [merge_pairs(p, self.ranks) for p in members]
            self.slots.update(zip(members, range(len(self.counts), len(self.counts) + len(members)), strict=True))
            self.counts.extend(map(len, merged))
            self.ids.extend(chain.from_iterable(merged))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each text has."""
        pieces, per_text = self.pieces(texts)
        if len(self.slots) > CACHED_PIECES:
            self.clear()
        self.learn(set(pieces).difference(self.slots))
        counts = np.array(self.counts)
        slot = np.fromiter(map(self.slots.__getitem__, pieces), np.int64, len(pieces))
        tokens = counts[slot]
        ids = np.array(self.ids)[ragged((np.cumsum(counts) - counts)[slot], tokens)]
        ends = np.append(0, np.cumsum(tokens))
        return ids, np.diff(ends[np.append(0, np.cumsum(per_text))])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other."""
        return self.content[ragged(self.start[ids], self.length[ids])]


    def decode_lists(self, ids: np.ndarray, offsets: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of each list of ids, as one binary value; the last token tells how long it is."""
        last = np.cumsum(counts) - 1
        sizes = np.where(counts > 0, offsets[last] + self.length[ids[last]], 0) if len(ids) else np.zeros(len(counts), np.int64)
        ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
        content = self.decode(ids)
        if len(content) != ends[-1]:
            raise ValueError("offsets and tokens disagree")
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(content)]
        return pa.Array.from_buffers(pa.binary(), len(counts), buffers)


@lru_cache(maxsize=4)
def coder(content: bytes) -> Coder:
    return Coder(content)


def long_text_parts(text: str, limit: int = LONG_TEXT) -> list[str]:
    """The text, cut before single blanks between words: there a piece starts whatever stands around."""
    parts, start = [], 0
    while len(text) - start > limit:
        at = start + limit
        while 0 <= at < len(text) - 1 and not (
            text[at] == " " and not text[at - 1].isspace() and not text[at + 1].isspace()
        ):
            at = text.find(" ", at + 1)
        if not start < at < len(text) - 1:
            break
        parts.append(text[start:at])
        start = at
    return [*parts, text[start:]]


def offsets_of(lengths: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Where each token starts in the bytes of its text."""
    before = np.cumsum(lengths) - lengths
    firsts = np.cumsum(per_text) - per_text
    base = np.append(before, 0)[np.minimum(firsts, len(before))]
    return (before - np.repeat(base, per_text)).astype(np.int32)


class ByteBpe:
    """Encoding and decoding by the ranks of one file, which the driver reads and sends to the tasks."""

    def __init__(self, path: str):
        self.content = Path(path).read_bytes()

    def _shared(self, df: DataFrame):
        ready_workers(df.sparkSession)
        return df.sparkSession.sparkContext.broadcast(self.content)

    def encode(self, df: DataFrame, text: str = "text", ids: str = "ids", offsets: str = "offsets",
               decoded: str | None = None) -> DataFrame:
        """Add the token ids of a text and the byte offset at which each token starts; if a name is given,
        also the bytes that the ids decode to, each token's put at its offset."""
        fields = [
            T.StructField(ids, T.ArrayType(T.IntegerType(), False), False),
            T.StructField(offsets, T.ArrayType(T.IntegerType(), False), False),
        ]
        if decoded:
            fields.append(T.StructField(decoded, T.BinaryType(), False))
        schema = with_fields(df, *fields)
        shared, arrow = self._shared(df), to_arrow_schema(schema)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = coder(shared.value)
            for batch in batches:
                for chunk in text_chunks(batch, text):
                    found, counts = encode_texts(own, text_of(chunk, text))
                    starts = offsets_of(own.length[found], counts)
                    new = {ids: lists(found, counts), offsets: lists(starts, counts)}
                    if decoded:
                        new[decoded] = own.decode_lists(found, starts, counts)
                    yield extended(chunk, arrow, new)

        return df.mapInArrow(work, schema)

    def decode(self, df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """Add the bytes that the ids stand for (null ids: none)."""
        schema = with_fields(df, T.StructField(decoded, T.BinaryType(), False))
        shared, arrow = self._shared(df), to_arrow_schema(schema)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = coder(shared.value)
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    rows = batch.slice(at, 256)
                    values = [own.decode(v).tobytes() for v in arrays_of(rows.column(ids))]
                    yield extended(rows, arrow, {decoded: pa.array(values, pa.binary())})

        return df.mapInArrow(work, schema)


def encode_texts(own: Coder, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As ``Coder.encode``, with long texts in parts, so that arrays stay bounded."""
    if len(texts) > 1 or not texts or len(texts[0]) <= LONG_TEXT:
        return own.encode(texts)
    done = [own.encode([part])[0] for part in long_text_parts(texts[0])]
    return np.concatenate(done), np.array([sum(map(len, done))])


def arrays_of(column: pa.Array) -> list:
    """The lists of a column as arrays, nulls as empty ones."""
    none = np.zeros(0, np.int64)
    return [v.values.to_numpy(zero_copy_only=False) if v.is_valid else none for v in column]


def path_of(name: str) -> str:
    """The place of an installed vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


