"""Benchmark decontamination by winnowing.

Every run of ``K`` words has a hash; of each ``W`` neighbouring runs the one
with the smallest hash is kept (the leftmost of equals), from documents and
benchmark items alike. A span of ``W + K - 1`` shared words therefore shares at
least one kept fingerprint, so joining the fingerprints finds every document
that can hold a whole window of an item. Hits are then extended word by word
around each shared fingerprint, and every word inside a shared window is marked.

An item of fewer words than a window is one window of its own; for such lengths
each run of that many words is a fingerprint (a winnowing window of one), so
short items are found as surely.

The benchmark side is measured first. Up to ``BROADCAST_BYTES`` of it, its
sorted fingerprints and words go to every task, documents are read once and
nothing is shuffled. A larger benchmark is worked through in blocks of that
size, one pass over the documents each, and the hits of the passes are added up
for each document: any size gives the same result in bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.frames import Shielded
from corpusmill.llm.packed import Words, chunks, pack, table

WINDOW = 10  # words of a benchmark window
K = 5  # words of a fingerprint
BROADCAST_BYTES = 32 << 20

#: Bytes of words, after lower-casing A-Z: digits, a-z and all of UTF-8's multi-byte characters.
WORD_BYTES = table(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100), *range(0x41, 0x5B)]))


def winnowed(hashes: np.ndarray, doc: np.ndarray, w: int) -> np.ndarray:
    """Indexes of the kept fingerprints: the leftmost smallest of each ``w``
    neighbours of one text, and the smallest of a text that has fewer."""
    n = len(hashes)
    if w == 1 or n == 0:
        return np.arange(n)
    spans = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    length = np.diff(np.r_[spans, n])
    # pad each text to at least w runs, so that short ones have a window too
    padded = np.maximum(length, w)
    begin = np.cumsum(np.r_[0, padded[:-1]])
    at = np.arange(n) - np.repeat(spans, length) + np.repeat(begin, length)
    total = int(padded.sum())
    values = np.full(total, np.iinfo(np.uint64).max, np.uint64)
    values[at] = hashes
    source = np.zeros(total, np.int64)
    source[at] = np.arange(n)
    best = np.arange(total - w + 1)
    least = values[: total - w + 1].copy()
    for j in range(1, w):
        other = values[j : total - w + 1 + j]
        less = other < least  # strict: the leftmost of equals stays
        least[less] = other[less]
        best[less] = np.flatnonzero(less) + j
    inside = np.repeat(begin, padded - w + 1) + np.concatenate([np.arange(m) for m in padded - w + 1])
    return np.unique(source[best[inside]])


class Benchmark:
    """Sorted fingerprints of items, and the items' words, for lookups in tasks."""

    def __init__(self, ids: list, texts: list[str], window: int, k: int):
        self.window, self.k = window, min(k, window)
        self.ids = ids
        data, off = pack(pa.array(texts, pa.large_string()))
        words = Words(data, off, WORD_BYTES)
        self.hash, self.first = words.hash, words.first
        self.texts = words
        count = np.diff(words.first)
        self.short = sorted({int(c) for c in count if 0 < c < window})
        self.tables: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # run length, winnowing width, hashes, first words
        long_enough = count >= window
        for size, width, use in [(self.k, window - self.k + 1, long_enough)] + [(n, 1, count == n) for n in self.short]:
            h, at = words.grams(size)
            own = use[words.doc[at]] if len(at) else np.zeros(0, bool)
            h, at = h[own], at[own]
            kept = winnowed(h, words.doc[at], width)
            order = np.argsort(h[kept], kind="stable")
            self.tables.append((size, width, h[kept][order], at[kept][order]))

    def word(self, i: int) -> bytes:
        return self.texts.low[self.texts.start[i] : self.texts.end[i]].tobytes()

    def hits(self, words: Words) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Marked words, and the items found in each text."""
        marked = np.zeros(len(words.hash) + 1, np.int64)  # +1 where a run of hits starts, -1 after it
        found: dict[int, set[int]] = {}
        seen: set[tuple[int, int]] = set()
        for size, width, hashes, firsts in self.tables:
            if not len(hashes):
                continue
            h, at = words.grams(size)
            kept = winnowed(h, words.doc[at], width)
            h, at = h[kept], at[kept]
            low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            for i in np.flatnonzero(high > low):
                for b in firsts[low[i] : high[i]]:
                    self._extend(words, int(at[i]), int(b), size, marked, found, seen)
        return np.cumsum(marked[:-1]) > 0, found

    def _extend(self, words: Words, a: int, b: int, size: int, marked, found, seen) -> None:
        doc, item = int(words.doc[a]), int(self.texts.doc[b])
        a0, a1 = int(words.first[doc]), int(words.first[doc + 1])
        b0, b1 = int(self.first[item]), int(self.first[item + 1])
        need = min(self.window, b1 - b0)
        left, most = 0, min(a - a0, b - b0)
        while left < most and words.hash[a - left - 1] == self.hash[b - left - 1]:
            left += 1
        begin = (a - left, b - left)
        if begin in seen:
            return
        seen.add(begin)
        right, most = 0, min(a1 - a, b1 - b)
        while right < most and words.hash[a + right] == self.hash[b + right]:
            right += 1
        if left + right < need:
            return
        same = [words.low[words.start[begin[0] + j] : words.end[begin[0] + j]].tobytes() == self.word(begin[1] + j) for j in range(left + right)]
        run = 0
        for j, equal in enumerate([*same, False]):  # whole words decide, not their hashes
            if equal:
                run += 1
                continue
            if run >= need:
                marked[begin[0] + j - run] += 1
                marked[begin[0] + j] -= 1
                found.setdefault(doc, set()).add(item)
            run = 0


def _blocks(benchmark: DataFrame, limit: int) -> list[tuple[int, int]]:
    """Ranges of a 32-bit hash of the item's key that hold at most about ``limit`` bytes each."""
    size = benchmark.agg(F.sum(F.length("_text").cast("long") * 4)).first()[0] or 0
    n = max(1, -(-int(size) // limit))
    return [(i, n) for i in range(n)]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    row_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    k: int = K,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` plus ``n_words``, ``n_hit`` (words inside an occurrence of a
    window), ``n_items``, ``items_sha256`` (the ids of the items found, sorted as
    strings, comma-joined) and ``contaminated``.

    Null or wordless texts have no words and hit nothing; a null or wordless item
    is found nowhere; a null item id is written as an empty string. An empty
    benchmark marks nothing. Repeated rows get equal results. Columns of ``docs``
    that have the names of the new ones are replaced. The benchmark is measured
    and read when this is called; the documents are read lazily."""
    side = Shielded(docs)
    body, rid = side.col(text), side.col(row_id)
    bench = benchmark.select(F.col(item_id).cast("string").alias("_id"), F.col(item_text).cast("string").alias("_text"))
    bench = bench.filter(F.col("_text").isNotNull())
    blocks = _blocks(bench, broadcast_bytes)
    spark = docs.sparkSession

    def loaded(i: int, n: int):
        part = bench if n == 1 else bench.filter(F.pmod(F.xxhash64("_id", "_text"), F.lit(n)) == i)
        rows = sorted((r._id or "", r._text) for r in part.collect())  # one block: its size is bounded
        return spark.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))

    if len(blocks) == 1:
        rows = _pass(side.df, body, loaded(*blocks[0]), window, k)
    else:
        rows = side.df.withColumn("_spans", F.array().cast("array<long>")).withColumn("_items", F.array().cast("array<string>"))
        rows = rows.withColumn("_words", F.lit(0).cast("long"))
        for b in blocks:
            rows = _pass(rows, body, loaded(*b), window, k)
    new = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    rows = rows.withColumn("_items", F.array_sort(F.array_distinct("_items")))
    values = (
        F.col("_words"),
        F.col("_hit"),
        F.size("_items").cast("long"),
        F.sha2(F.array_join("_items", ","), 256),
        F.col("_hit") > 0,
    )
    own = [F.col(c).alias(n) for c, n in zip(side.columns, side.names) if n not in new]
    return rows.select(*own, *[v.alias(n) for v, n in zip(values, new)])


def _pass(rows: DataFrame, body: str, held, window: int, k: int) -> DataFrame:
    """Adds one block's hits: ``_spans`` (starts and ends of marked runs, over all
    passes so far), ``_items``, ``_words`` and ``_hit``."""
    earlier = "_spans" in rows.columns
    keep = [f for f in rows.schema.fields if f.name not in ("_spans", "_items", "_words", "_hit")]
    schema = T.StructType([
        *keep,
        T.StructField("_spans", T.ArrayType(T.LongType())),
        T.StructField("_items", T.ArrayType(T.StringType())),
        T.StructField("_words", T.LongType()),
        T.StructField("_hit", T.LongType()),
    ])
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts = held.value
        bench = Benchmark(ids, texts, window, k)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(body))
            data, off = pack(column)
            spans, items, counts, hit = [], [], [], []
            for a, b in chunks(off):
                words = Words(data[off[a] : off[b]], off[a : b + 1] - off[a], WORD_BYTES)
                marked, found = bench.hits(words)
                sums = np.r_[0, np.cumsum(marked)]
                for i in range(b - a):
                    w0, w1 = int(words.first[i]), int(words.first[i + 1])
                    counts.append(w1 - w0)
                    old = batch.column(batch.schema.get_field_index("_spans"))[a + i].as_py() if earlier else []
                    n = int(sums[w1] - sums[w0])
                    if not n and not old:
                        spans.append([])
                        hit.append(0)
                    else:
                        own = np.r_[False, marked[w0:w1], False]
                        for s, e in zip(old[::2], old[1::2]):
                            own[s + 1 : e + 1] = True
                        turns = np.flatnonzero(own[1:] != own[:-1])
                        spans.append(turns.tolist())
                        hit.append(int(own.sum()))
                    before = batch.column(batch.schema.get_field_index("_items"))[a + i].as_py() if earlier else []
                    items.append(before + [ids[j] for j in sorted(found.get(i, ()))])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(n)) for n in names], pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())), pa.array(counts, pa.int64()), pa.array(hit, pa.int64())],
                names=[*names, "_spans", "_items", "_words", "_hit"],
            )

    return rows.mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", row_id: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, with their columns as they are."""
    side = Shielded(docs)
    out = contamination(side.df, benchmark, side.col(text), side.col(row_id), **how)
    return side.restore(out.filter(~F.col("contaminated")))
