"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of ASCII letters, digits and underscores and of all bytes of characters
beyond ASCII, in the lower-cased text. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd

_MASK = 2**64 - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_VALUES = np.random.default_rng(20240117).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ..."""
    out = np.full(n, base & _MASK, dtype=np.uint64)
    if n:
        out[0] = 1
        np.cumprod(out, out=out)
    return out


@dataclass
class Words:
    hashes: np.ndarray  # of all words in order
    starts: np.ndarray  # byte offsets in `blob`
    ends: np.ndarray
    first: np.ndarray  # first[i]: number of words before text i; one more entry than texts
    blob: bytes


def words_of(texts: list[str]) -> Words:
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    blob = b"\n".join(parts) + b"\n"
    data = np.frombuffer(blob, dtype=np.uint8)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[1:] = _IN_WORD[data]
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * powers(_BASE, len(data)), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))
    offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets), blob)


def shingles_of(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words inside a text, and where each text's begin (texts + 1 entries).

    A text of fewer words (but one at least) has a single shingle, of all its words.
    """
    counts = np.diff(words.first)
    n = len(words.hashes)
    rolled = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for i in range(width):
        rolled = mixed(rolled + words.hashes[i: i + len(rolled)])
    of_text = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(n) - words.first[:-1][of_text]
    whole = place + width <= counts[of_text]
    keep = np.flatnonzero(whole)
    short = np.flatnonzero((counts > 0) & (counts < width))
    values, owner = rolled[keep], of_text[keep]
    if len(short):
        lone = np.array([
            int(mixed(np.cumsum(mixed(words.hashes[words.first[i]: words.first[i + 1]] * np.uint64(3)))[-1:])[0]) for i in short
        ], dtype=np.uint64)
        values, owner = np.concatenate([values, lone]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


def spaced_words(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """All words between ASCII white space in order, how many each text has, the number of each word's form, and the forms."""
    words: list[bytes] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        own = text.encode("utf-8", "surrogatepass").split()
        counts[i] = len(own)
        words += own
    cells = np.empty(len(words), dtype=object)
    cells[:] = words
    number, forms = pd.factorize(cells)
    return words, counts, number, forms


def groups_of(texts: list[str], most_chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about `most_chars` characters (a longer text stands alone)."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most_chars:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)
