"""Words of many texts as arrays: where they are, and one number for each, without a loop over words."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: An odd number, so that its powers can be divided out modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Code points of one text that are hashed at once.
LONG_TEXT = 1 << 20
MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=1)
def word_points() -> np.ndarray:
    """True for code points that belong to words: letters, marks and digits."""
    import unicodedata

    category = unicodedata.category
    return np.fromiter((category(chr(c))[0] in "LMN" for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=4)
def powers(n: int) -> np.ndarray:
    """BASE raised to 0, 1, … n - 1 modulo 2^64."""
    found = np.full(n, BASE, np.uint64)
    found[:1] = 1
    return np.cumprod(found, dtype=np.uint64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every lower-cased word of all texts, and the number of words of each text.

    A word is a run of letters, marks and digits. Its hash is a polynomial of its code points, summed
    for all words at once. A long text is taken in parts that end behind a line or a blank.
    """
    if len(texts) == 1 and len(texts[0]) > LONG_TEXT:
        found = [word_hashes([part])[0] for part in parts_of(texts[0])]
        return np.concatenate(found), np.array([sum(map(len, found))])
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le"), np.uint32)
    inside = word_points()[points]
    edges = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    lengths = ends - starts
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    firsts = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = (points[inside].astype(np.uint64) + np.uint64(1)) * powers(1 << int(lengths.max()).bit_length())[within]
    hashes = np.add.reduceat(values, firsts)
    hashes ^= lengths.astype(np.uint64) << np.uint64(56)
    hashes = (hashes ^ (hashes >> np.uint64(31))) * MIX
    hashes ^= hashes >> np.uint64(29)
    text_ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)
    return hashes, np.diff(np.searchsorted(starts, np.append(0, text_ends)))


def parts_of(text: str) -> list[str]:
    """The text in parts, cut behind white space wherever there is any."""
    parts, start = [], 0
    while len(text) - start > LONG_TEXT:
        middle = start + LONG_TEXT
        at = max(text.rfind(" ", start, middle), text.rfind("\n", start, middle)) + 1
        if at <= start:
            at = text.find(" ", middle) + 1
        if at <= start:
            break
        parts.append(text[start:at])
        start = at
    return [*parts, text[start:]]
