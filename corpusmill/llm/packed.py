"""Whole Arrow batches of texts as one byte array, worked on with numpy.

Positions index the bytes of all texts of a batch laid end to end; ``off[i]``
to ``off[i + 1]`` is text ``i``. Nothing here reads across two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
CHUNK = 1 << 19  # bytes of text worked on at once; a longer text is a chunk of its own


def pack(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, values = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes (or of one text)."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to ``n``."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, CHUNK + 1)
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, base in (("up", BASE), ("down", inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def table(chars: bytes) -> np.ndarray:
    """Membership of each byte value in ``chars``."""
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of texts: runs of bytes for which ``is_word`` holds, after
    lower-casing A-Z. ``doc`` is each word's text, ``first`` each text's first
    word (with one more entry at the end), ``hash`` 64 bits of each word."""

    def __init__(self, data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
        low = LOWER[data]
        member = is_word[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True  # a word never runs over the border of two texts
        n = len(data)
        before = np.zeros(n, bool)
        before[1:] = member[:-1]
        before &= ~edge[:n]
        after = np.zeros(n, bool)
        after[:-1] = member[1:]
        after &= ~edge[1:]
        self.start = np.flatnonzero(member & ~before)
        self.end = np.flatnonzero(member & ~after) + 1
        self.low = low
        self.first = np.searchsorted(self.start, off)
        counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), counts)
        up, down = powers(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64, out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``k`` words inside one text, and its first word."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return gram_hash([self.hash[at + j] for j in range(k)], k), at


def gram_hash(words: list[np.ndarray], k: int) -> np.ndarray:
    """Hash of ``k`` words in order from the words' hashes."""
    h = np.full_like(words[0], np.uint64(k))
    for w in words:
        h = mix(h * BASE + w)
    return h


def sequence_hash(words: np.ndarray) -> np.uint64:
    """As ``gram_hash`` of all of one text's words."""
    return gram_hash([words[j : j + 1] for j in range(len(words))], len(words))[0]
