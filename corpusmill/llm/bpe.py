"""Byte-level byte-pair encoding on padded matrices.

Pieces (matches of the split pattern) that have not been met yet are gathered
over a batch, laid out as rows of matrices by length, and merged in rounds: in
each round every row merges its leftmost pair of the smallest rank, looked up in
a hash table of pairs, and the row is compacted; rows without a pair left are
done and leave the matrix. The merged token of two neighbours is the vocabulary
entry for their joined bytes, so the result is that of merging by rank.

A piece longer than ``LONG`` bytes goes through the same merges with a heap of
pairs, since each round of a matrix shortens a row by one.

Texts are cut at single spaces between two visible characters, where no match
of the pattern can reach across; the encoding of such a chunk is remembered
(``REMEMBERED`` chunks at a time, those met last), as prose repeats them.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusmill.functions.udf import worker_resource
from corpusmill.llm.frames import Shielded

LONG = 256
REMEMBERED = 150_000
CELLS = 1 << 19  # of the pair table; probing is linear
NO_RANK = np.int32(2**31 - 1)


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for cycles among the many small objects made in here, which have none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class PairTable:
    """(left id, right id) -> id of the joined token, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.cells = CELLS
        while self.cells < 2 * len(pairs):
            self.cells *= 2
        self.key = np.full(self.cells, -1, np.int64)
        self.rank = np.full(self.cells, NO_RANK, np.int32)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        at = self._cell(keys)
        self.probes = 0
        left = np.arange(len(keys))
        while len(left):
            self.probes += 1
            free = self.key[at[left]] == -1
            self.key[at[left[free]]] = keys[left[free]]  # of several, one is kept
            won = self.key[at[left]] == keys[left]
            self.rank[at[left[won]]] = values[left[won]]
            left = left[~won]
            at[left] = (at[left] + 1) & (self.cells - 1)
        self.pairs = pairs

    def _cell(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(32)).astype(np.int64) & (self.cells - 1)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        out = np.full(keys.shape, NO_RANK, np.int32)
        at = self._cell(keys)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        keys, at, flat = keys.ravel(), at.ravel(), out.ravel()
        for _ in range(self.probes):
            found = self.key[at[todo]] == keys[todo]
            flat[todo[found]] = self.rank[at[todo[found]]]
            todo = todo[~found & (self.key[at[todo]] != -1)]
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & (self.cells - 1)
        return flat.reshape(left.shape)


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.table = PairTable(ranks)
        self.whole = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.said = list(map(str, range(len(self.token))))
        self.known: dict[str, tuple[str, int, bytes]] = {}  # chunk -> ids as text, their number, their bytes
        self.older: dict[str, tuple[str, int, bytes]] = {}  # those before them

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        lengths = np.array([len(p) for p in pieces], np.int64)
        for i in np.flatnonzero(lengths > LONG):
            out[i] = self._by_heap(pieces[i])
        low = 0
        for high in (2, 4, 6, 8, 12, 16, 32, 64, 128, LONG):
            rows = np.flatnonzero((lengths > low) & (lengths <= high))
            for a in range(0, len(rows), 65536):
                part = rows[a : a + 65536]
                for i, ids in zip(part, self._by_matrix([pieces[i] for i in part], high)):
                    out[i] = ids
            low = high
        return out

    def _by_matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        n = len(pieces)
        length = np.array([len(p) for p in pieces], np.int64)
        padded = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        ids = self.byte_id[padded]
        ids[np.arange(width) >= length[:, None]] = -1
        done: list[np.ndarray | None] = [None] * n
        rows = np.arange(n)
        while len(rows):
            ranks = self.table(ids[:, :-1], ids[:, 1:]) if ids.shape[1] > 1 else np.full((len(rows), 1), NO_RANK, np.int32)
            at = ranks.argmin(1)  # the leftmost of the smallest
            best = ranks[np.arange(len(rows)), at]
            over = best == NO_RANK
            for k in np.flatnonzero(over):
                done[rows[k]] = ids[k, : length[k]]
            go = ~over
            rows, ids, length, at, best = rows[go], ids[go], length[go], at[go], best[go]
            if not len(rows):
                break
            ids[np.arange(len(rows)), at] = best
            column = np.arange(ids.shape[1] - 1)
            shifted = column + (column > at[:, None])  # the right half of the pair goes
            ids = np.take_along_axis(ids, shifted, 1)
            length -= 1
        return done

    def _by_heap(self, piece: bytes) -> np.ndarray:
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        n, pairs = len(ids), self.table.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := pairs.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], np.int32)

    def learn(self, chunks: set[str]) -> None:
        """Encodes chunks that are not known."""
        split = {c: self.split(c) for c in chunks}
        pieces = list(set(itertools.chain.from_iterable(split.values())))
        ids = {p: got.tolist() for p, got in zip(pieces, self.merge([p.encode("utf-8") for p in pieces]))}
        said, token = self.said, self.token
        for c, ps in split.items():
            got = ids[ps[0]] if len(ps) == 1 else [x for p in ps for x in ids[p]]
            self.known[c] = (" ".join([said[x] for x in got]), len(got), b"".join([token[x] for x in got]))

    def encode(self, texts: list[str]) -> Iterator[tuple[str, int, bytes]]:
        """For each text its ids as decimal numbers joined by spaces, their
        number, and the bytes they decode to."""
        for a in range(0, len(texts), 64):
            cut = [chunked(t) for t in texts[a : a + 64]]
            needed = set().union(*cut)
            new = needed - self.known.keys()
            if len(self.known) + len(new) > REMEMBERED // 2:
                # what was met since the last time stays, at hand until it is met again
                self.older, self.known = self.known, {c: self.known[c] for c in needed - new}
            for c in new & self.older.keys():
                self.known[c] = self.older[c]
                new.remove(c)
            if new:
                with uncollected():
                    self.learn(new)
            known = self.known.__getitem__
            for parts in cut:
                if parts:
                    said, n, decoded = zip(*map(known, parts))
                    yield " ".join(said), sum(n), b"".join(decoded)
                else:
                    yield "", 0, b""


#: Before a single space between two characters that are not white space.
CUT = re.compile(r"(?<=\S)(?= \S)")


def chunked(text: str) -> list[str]:
    """``text`` in pieces that the split pattern treats independently."""
    if not text:
        return []
    words = text.split()
    if len(text) != sum(map(len, words)) + len(words) - 1:  # runs of white space, or some at an end
        return CUT.split(text)
    out = []
    for line in text.split("\n"):  # a single line break is a match of its own
        first, *rest = line.split(" ")
        out.append(first)
        out += [" " + x for x in rest]
        out.append("\n")
    out.pop()
    return out


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encode_decode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: bool = True) -> DataFrame:
    """``docs`` plus ``token_ids``, ``n_tokens``, ``ids_sha256`` (of the decimal
    ids joined by one space) and ``decoded_sha256`` (of the bytes the ids decode
    to; equal to the text's own bytes).

    ``ids=False`` leaves the array out. Null and empty texts have no tokens. Repeated rows get equal results. Columns
    of ``docs`` with the names of the new ones are replaced. ``rank_file`` is read
    on the driver and its ranks are broadcast (the vocabulary is of fixed size)."""
    side = Shielded(docs)
    body = side.col(text)
    held = docs.sparkSession.sparkContext.broadcast(load_ranks(rank_file))
    new = [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    new = new if ids else new[1:]
    schema = T.StructType([*side.df.schema.fields, *new])
    names = [f.name for f in new]
    key = f"bpe:{rank_file}:{pattern}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_resource(lambda: ByteBpe(held.value, pattern), key)
        for batch in batches:
            at = batch.schema.get_field_index(body)
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                arrays, counts, id_sha, text_sha = [], [], [], []
                for said, n, decoded in bpe.encode([t or "" for t in part.column(at).to_pylist()]):
                    if ids:
                        arrays.append(np.fromstring(said, np.int32, sep=" ") if n else np.zeros(0, np.int32))
                    counts.append(n)
                    id_sha.append(hashlib.sha256(said.encode("ascii")).hexdigest())
                    text_sha.append(hashlib.sha256(decoded).hexdigest())
                columns = [pa.array(counts, pa.int64()), pa.array(id_sha), pa.array(text_sha)]
                if ids:
                    offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
                    columns = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays))), *columns]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*batch.schema.names, *names])

    out = side.df.mapInArrow(run, schema)
    own = [out[c].alias(n) for c, n in zip(side.columns, side.names) if n not in names]
    return out.select(*own, *names)
