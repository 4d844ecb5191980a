"""Exact Jaccard self-join of word n-gram sets by PartEnum signatures.

Two sets of sizes a <= b with Jaccard similarity of at least p/q differ in at
most (a + b)(q - p)/(q + p) features. The feature domain (64-bit shingle hashes)
is cut into partitions; with two second-level partitions to a first-level one
and one of them allowed to differ, the enumerated subsets are the second-level
partitions themselves, and a set's signature for one is a hash of the features
it has there. Sets are banded by size: sizes of one band share a number of
partitions, and a set also emits the signatures of the next band when a similar
set can be large enough to be there.

If a set emits its first k + 1 non-empty partitions, k being the largest
difference to any similar set of the band, one of them agrees with the similar
set; emitting r more makes every similar pair share at least r + 1 signatures. A
set with fewer non-empty partitions emits all of them and every single feature,
so two such sets meet in a common feature. No similar pair is missed, whatever
the data (up to 64-bit collisions of features; pairs are verified on the texts).

The r spare signatures pay for frequent ones (shared by more than ``FREQUENT``
sets, as a passage repeated in many documents makes): by the prefix argument a
set may drop its r most frequent frequent signatures, since a similar pair whose
shared signatures are all frequent still shares a less frequent one that both
keep.

The work, none of which gathers a group in one task or on the driver:

1. every text's set gives a size and a 128-bit set hash; equal sets are one
   class from here on, so copies cost nothing more;
2. signatures go to buckets, packed (about 6 bytes each), and each bucket, whose
   number follows the data, reports the groups of classes that share one;
3. each class is compared with the class it shares most signatures with, and
   what that links is named after the centre;
4. pairs that share a signature but not yet a name are compared too, and the
   components of all links are the result. Pairs of the rarer signatures are
   listed (a signature has at most ``FREQUENT`` sets there). Sets that only meet in
   frequent ones are gathered into clusters, dealt into blocks of ``BLOCK`` by size,
   and compared block against block in numpy; only pairs that may be similar come
   out, so no group's pairs are listed. That work is quadratic in the number of
   sets of a cluster that are not similar to its centre, which no exact join avoids.

A comparison first looks at the sizes and at count sketches of the two sets, whose
differences cannot exceed the sets' own; of pairs that only share some signatures,
most pass that and few are similar, so sketches as fine as the sets are large are
compared next. What passes is verified on the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.udf import give_back, release_resources
from corpusmill.llm.components import components
from corpusmill.llm.frames import Shielded, row_key
from corpusmill.llm.packed import Words, chunks, gram_hash, mix, pack, sequence_hash, table
from corpusmill.session import materialize

SHINGLE = 5
ALIKE = (75, 100)  # similarity of at least 75 / 100
RATIO = 1.6  # between the largest sizes of neighbouring bands
LOAD = 2.7  # features in a partition, for the largest set of a band
FREQUENT = 6
GROUP = 32  # neighbouring partitions whose signatures share a bucket
SPLIT_SHINGLES = 60_000_000  # a bucket is split in two for each so many
HELD_SIGNATURES = 600_000
BROADCAST_ROWS = 300_000
CELLS = 256  # of a set's count sketch
BLOCK = 512  # sets compared with as many others in one step
STEP = 1.07  # ratio of the sizes in a block

#: Words are runs of anything but space and the control characters 9 to 13.
NOT_SPACE = ~table(bytes([0x20, *range(0x09, 0x0E)]))


class Bands:
    """Sizes, partitions and signature numbers of the bands for a similarity."""

    def __init__(self, alike: tuple[int, int]):
        self.p, self.q = alike
        self.top = [1]
        while self.top[-1] < 1 << 40:
            self.top.append(max(self.top[-1] + 1, int(self.top[-1] * RATIO)))
        self.parts = [max(1, int(t / LOAD)) for t in self.top]
        self.spare = [n // 8 + 1 for n in self.parts]

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.top, size, "left"))

    def largest(self, size: int) -> int:
        return size * self.q // self.p

    def emitted(self, size: int) -> list[tuple[int, int]]:
        """(band, number of signatures) that a set of this size emits."""
        out = []
        for band in range(self.band(size), self.band(self.largest(size)) + 1):
            partner = min(self.top[band], self.largest(size))
            differ = (size + partner) * (self.q - self.p) // (self.q + self.p)
            out.append((band, differ + 1 + self.spare[band]))
        return out


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes."""
    words = Words(data, off, NOT_SPACE)
    hashes, at = words.grams(k)
    begin = np.searchsorted(at, words.first)  # a text's shingles start at its words
    for i in range(len(off) - 1):
        n = int(words.first[i + 1] - words.first[i])
        if n >= k:
            yield np.unique(hashes[begin[i] : begin[i + 1]])
        elif n:
            yield np.array([sequence_hash(words.hash[words.first[i] : words.first[i + 1]])], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def set_hash(features: np.ndarray) -> tuple[int, int]:
    a = np.add.reduce(mix(features), dtype=np.uint64) + np.uint64(len(features))
    b = np.add.reduce(mix(features ^ np.uint64(0xA5A5A5A55A5A5A5A)), dtype=np.uint64)
    return tuple(mix(np.array([a, b], np.uint64)).view(np.int64).tolist())


def sketch(features: np.ndarray) -> bytes:
    """How many features fall into each of ``CELLS`` cells, up to 255. The sum of two
    sketches' differences is at most the number of features that the sets differ in."""
    return np.minimum(np.bincount((features & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8).tobytes()


def fine_sketch(features: np.ndarray) -> bytes:
    """As ``sketch``, with a cell for each feature, to the next power of two. A finer
    sketch folds into a coarser one."""
    cells = max(CELLS, 1 << (max(1, len(features)) - 1).bit_length())
    return np.minimum(np.bincount((features & np.uint64(cells - 1)).astype(np.int64), minlength=cells), 255).astype(np.uint8).tobytes()


def apart(one: bytes, two: bytes) -> int:
    """The least number of features in which two sets with these sketches differ. A cell
    of 255 may hold more, so it is taken as equal to any other of that many."""
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (one, two))
    if len(a) < len(b):
        a, b = b, a
    full = (a == 255).any()
    a = a.reshape(-1, len(b)).sum(0)
    if full or (b == 255).any():
        a, b = np.minimum(a, 255), np.minimum(b, 255)
    return int(np.abs(a - b).sum())


def signatures(features: np.ndarray, bands: Bands) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(band, signatures, their partitions) of one set given as sorted hashes."""
    spread = mix(features)
    for band, number in bands.emitted(len(features)):
        seed = np.uint64((band + 1) * 0x632BE59BD9B4E019 % (1 << 64))
        part = ((features >> np.uint64(32)) * np.uint64(min(bands.parts[band], 1 << 31))) >> np.uint64(32)
        start = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        if len(start) >= number:
            last = start[number] if len(start) > number else len(features)
            yield band, mix(np.add.reduceat(spread[:last], start[:number]) ^ seed), part[start[:number]]
        else:
            yield band, np.r_[mix(np.add.reduceat(spread, start) ^ seed), mix(spread ^ ~seed)], np.r_[part[start], part]


def similarity_components(
    docs: DataFrame,
    text: str = "text",
    row_id: str = "doc_id",
    shingle: int = SHINGLE,
    alike: tuple[int, int] = ALIKE,
    frequent: int = FREQUENT,
) -> DataFrame:
    """A row for each row of ``docs``: its id (under its name), ``n_shingles`` (size
    of its set), ``class_id`` (hash of the set, null for an empty one; equal sets
    share it), ``component_id`` (the smallest id that links reach from the row, its
    own included) and the key ``_ka``, ``_kb`` of ``row_key``.

    Texts without words (null and empty ones too) have an empty set and link with
    nothing. A text of fewer words than a shingle has one feature, the whole
    sequence. Repeated rows link with each other; a null id is never the smallest,
    and a component of null ids has none. An empty table gives an empty result.
    Other columns of ``docs`` are not looked at. The join runs when this is called,
    writing its steps to the shared checkpoint folder."""
    if 4 * alike[0] < 3 * alike[1]:
        raise ValueError("the numbers of signatures hold for similarities of 3/4 and more")
    if row_id not in docs.columns or text not in docs.columns:
        raise ValueError(f"no column {row_id!r} or {text!r}; columns are {docs.columns}")
    side = Shielded(docs)
    rid, body = side.col(row_id), side.col(text)
    rows = side.df.select(*row_key(rid, body), F.col(rid).alias("_id"), F.col(body).cast("string").alias("_body"))
    sets = materialize(_sets(rows, shingle), "partenum-sets")
    links = materialize(similar_pairs(rows, sets, shingle, alike, frequent), "partenum-links")
    label = components(links).select(F.col("node").alias("h1"), "label")
    least = sets.filter("n > 0").groupBy("h1").agg(F.min("_id").alias("least"))
    label = least.join(label, "h1", "left").withColumn("label", F.coalesce("label", "h1"))
    whole = label.groupBy("label").agg(F.min("least").alias("whole"))
    label = label.join(whole, "label").select("h1", "whole")
    filled = F.col("n") > 0
    return sets.join(label, "h1", "left").select(
        F.col("_id").alias(row_id),
        F.col("n").alias("n_shingles"),
        F.when(filled, F.concat(F.lpad(F.hex("h1"), 16, "0"), F.lpad(F.hex("h2"), 16, "0"))).alias("class_id"),
        F.when(filled, F.col("whole")).otherwise(F.col("_id")).alias("component_id"),
        "_ka",
        "_kb",
    )


def drop_similar(docs: DataFrame, text: str = "text", row_id: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` that stay, with its columns as they are: of each
    component the row with the smallest id, and every row with an empty set. Rows
    equal in id and text are one document here and stay or go together; so do
    rows of one component that share its smallest id, or have no id at all."""
    side = Shielded(docs)
    rid, body = side.col(row_id), side.col(text)
    found = similarity_components(side.df.select(rid, body), body, rid, **how)
    gone = found.filter(F.col(rid).isNull() & F.col("component_id").isNotNull() | (F.col(rid) != F.col("component_id")))
    gone = materialize(gone.select(F.col("_ka").alias("_ga"), F.col("_kb").alias("_gb")).distinct(), "partenum-gone")
    rows = side.df.select(*side.columns, *row_key(rid, body))
    out = rows.join(_small(gone), (F.col("_ka") == F.col("_ga")) & (F.col("_kb") == F.col("_gb")), "left_anti")
    return side.restore(out)


def _small(written: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has few enough rows."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_resources()  # what other jobs left in this worker
        for batch in batches:
            data, off = pack(batch.column(3))
            sizes, ones, twos, cells = [], [], [], []
            for a, b in chunks(off):
                for features in shingle_sets(data[off[a] : off[b]], off[a : b + 1] - off[a], shingle):
                    one, two = set_hash(features)
                    sizes.append(len(features))
                    ones.append(one)
                    twos.append(two)
                    cells.append(sketch(features))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64()), pa.array(cells, pa.binary())],
                names=["_ka", "_kb", "_id", "n", "h1", "h2", "cells"],
            )

    id_type = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_ka long, _kb long, _id {id_type}, n long, h1 long, h2 long, cells binary")


def _payloads(sigs: np.ndarray, part: np.ndarray, entry: np.ndarray, h1: np.ndarray, size: np.ndarray, band: np.ndarray, splits: int) -> Iterator[tuple[int, bytes]]:
    """Signatures by bucket (a stretch of a band's partitions, so that a class has
    many in one), each as: number of entries, their class, size, band and number of
    signatures, then five bytes of each signature."""
    bucket = (band[entry].astype(np.int64) << 32 | (part // np.uint64(GROUP)).astype(np.int64)) * splits + (sigs % np.uint64(splits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, entry, sigs = bucket[order], entry[order], sigs[order]
    edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    for a, b in zip(edge[:-1], edge[1:]):
        own = entry[a:b]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        e = own[first]
        count = np.diff(np.r_[first, b - a])
        five = np.ascontiguousarray(sigs[a:b] >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]
        parts = (np.array([len(e)], np.uint32), h1[e], size[e], band[e], count.astype(np.uint32), five)
        yield int(bucket[a]), b"".join(x.tobytes() for x in parts)


def _unpack(payload: bytes) -> tuple[np.ndarray, ...]:
    n = int(np.frombuffer(payload, np.uint32, 1)[0])
    at, out = 4, []
    for kind in (np.int64, np.uint32, np.uint8, np.uint32):
        out.append(np.frombuffer(payload, kind, n, at))
        at += n * np.dtype(kind).itemsize
    five = np.frombuffer(payload, np.uint8, offset=at).reshape(-1, 5)
    wide = np.zeros((len(five), 8), np.uint8)
    wide[:, :5] = five
    h1, size, band, count = out
    return wide.view(np.uint64).ravel(), np.repeat(h1, count), np.repeat(size, count), np.repeat(band, count)


def _packed_signatures(rows: DataFrame, shingle: int, bands: Bands, splits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_resources()
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray, int, int, int]] = []
        total = 0

        def flush() -> pa.RecordBatch:
            sigs, part = (np.concatenate([x[j] for x in held]) for j in (0, 1))
            entry = np.repeat(np.arange(len(held)), [len(x[0]) for x in held])
            h1, size, band = (np.array([x[j] for x in held], kind) for j, kind in ((2, np.int64), (3, np.uint32), (4, np.uint8)))
            out = list(_payloads(sigs, part, entry, h1, size, band, splits))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int64()), pa.array([p for _, p in out], pa.binary())], names=["bucket", "payload"])

        for batch in batches:
            data, off = pack(batch.column(0))
            for a, b in chunks(off):
                for features in shingle_sets(data[off[a] : off[b]], off[a : b + 1] - off[a], shingle):
                    if not len(features):
                        continue
                    one = set_hash(features)[0]
                    if one in seen:
                        continue  # an equal set of this task has emitted them
                    if len(seen) >= 500_000:
                        seen.clear()
                    seen.add(one)
                    for band, sigs, part in signatures(features, bands):
                        held.append((sigs, part, one, len(features), band))
                        total += len(sigs)
                if total >= HELD_SIGNATURES:
                    yield flush()
                    total = 0
        if held:
            yield flush()
        seen.clear()
        give_back()

    return rows.select("_body").mapInArrow(run, "bucket long, payload binary")


def _groups_of(payloads: list[bytes]) -> pa.Table:
    """The distinct sets of two or more classes that share a signature of a bucket:
    a row for each member, with the number of signatures they share and the members'
    number."""
    parts = [_unpack(p) for p in payloads]
    sig, h1, size, band = (np.concatenate([p[j] for p in parts]) for j in range(4))
    key = (sig << np.uint64(8)) | band.astype(np.uint64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = np.r_[False, key[1:] == key[:-1]]
    shared = same | np.r_[same[1:], False]
    order, key = order[shared], key[shared]
    h1, size = h1[order], size[order]
    order = np.lexsort((h1, key))
    key, h1, size = key[order], h1[order], size[order]
    once = np.r_[True, (key[1:] != key[:-1]) | (h1[1:] != h1[:-1])] if len(key) else np.zeros(0, bool)
    key, h1, size = key[once], h1[once], size[once]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    number = np.diff(np.r_[start, len(key)])
    start, number = start[number > 1], number[number > 1]
    if len(start):
        member = np.repeat(number, number)
        take = np.repeat(start, number) + np.arange(len(member)) - np.repeat(np.cumsum(np.r_[0, number[:-1]]), number)
        bound = np.cumsum(np.r_[0, number[:-1]])
        group = mix(np.add.reduceat(mix(h1[take].view(np.uint64)), bound) + number.astype(np.uint64) + (key[start] & np.uint64(255)) * np.uint64(0x9E3779B97F4A7C15))
        group, first, times = np.unique(group, return_index=True, return_counts=True)
        start, number = start[first], number[first]
        rep = lambda x: np.repeat(x, number)
        bound = np.cumsum(np.r_[0, number[:-1]])
        take = rep(start) + np.arange(int(number.sum())) - rep(bound)
        columns = [rep(group.view(np.int64)), rep(times), rep(number), h1[take], size[take].astype(np.int64), rep((key[start] & np.uint64(255)).astype(np.int64))]
    else:
        columns = [np.zeros(0, np.int64)] * 6
    names = ["g", "times", "m", "h1", "n", "band"]
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(names, columns)})


def similar_pairs(rows: DataFrame, sets: DataFrame, shingle: int, alike: tuple[int, int], frequent: int) -> DataFrame:
    """Links ``(a, b)`` between classes (``h1`` of ``sets``) that connect exactly
    the components of all similar pairs."""
    bands = Bands(alike)
    total = sets.agg(F.sum("n")).first()[0] or 0
    schema = "g long, times long, m long, h1 long, n long, band long"
    packed = _packed_signatures(rows, shingle, bands, int(total) // SPLIT_SHINGLES + 1)
    shared = packed.groupBy("bucket").applyInArrow(lambda t: _groups_of(t.column("payload").to_pylist()), schema)
    shared = materialize(shared, "partenum-shared")

    # each class with the class it shares most signatures with, among pivots of groups:
    # a group's pivot is the member that shares most signatures with any others
    met = materialize(shared.groupBy("h1").agg(F.sum(F.col("times") * (F.col("m") - 1)).alias("met")), "partenum-met")
    pivots = shared.join(_small(met), "h1").groupBy("g").agg(F.max(F.struct("met", "h1")).alias("top"))
    first = shared.join(pivots.select("g", F.col("top.h1").alias("pivot")), "g").filter("h1 <> pivot").groupBy("h1", "pivot").agg(F.sum("times").alias("times"))
    first = first.groupBy("h1").agg(F.max(F.struct("times", "pivot")).alias("best")).filter("best.times > 1")
    first = first.select(F.col("h1").alias("a"), F.col("best.pivot").alias("b"))
    classes = sets.join(shared.select("h1").distinct(), "h1", "left_semi").groupBy("h1").agg(F.first("n").alias("n"), F.first("cells").alias("cells"), F.min(F.struct("_ka", "_kb")).alias("k"))
    classes = materialize(classes, "partenum-classes")
    links = materialize(verified(first, rows, classes, shingle, alike), "partenum-links")
    # a name for what is linked so far: the pivot, or the pivot's pivot
    hop = links.select(F.col("a").alias("b"), F.col("b").alias("far"))
    label = links.join(hop, "b", "left").select(F.col("a").alias("h1"), F.coalesce("far", "b").alias("label"))

    # what shares a signature but not yet a name
    pairs = _rare_pairs(shared.filter(F.col("m") <= frequent), label, alike).union(
        _cluster_pairs(_without_most_frequent(shared.filter(F.col("m") > frequent), bands), label, classes, alike)
    )
    return links.select("a", "b").union(verified(pairs.distinct(), rows, classes, shingle, alike, sieve=True))


def _labelled(members: DataFrame, label: DataFrame) -> DataFrame:
    return members.join(label, "h1", "left").withColumn("label", F.coalesce("label", "h1"))


def _rare_pairs(shared: DataFrame, label: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """Pairs of different names in one group, for groups of bounded size."""
    rest = materialize(_labelled(shared.select("g", "h1", "n").distinct(), label), "partenum-rest")
    mixed = rest.groupBy("g").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("g")
    rest = rest.join(mixed, "g")
    one, two = (rest.select("g", *[F.col(c).alias(f"{c}_{x}") for c in ("h1", "n", "label")]) for x in "ab")
    near = F.greatest("n_a", "n_b") * F.lit(alike[0]) <= F.least("n_a", "n_b") * F.lit(alike[1])
    pairs = one.join(two, "g").filter((F.col("label_a") != F.col("label_b")) & (F.col("h1_a") < F.col("h1_b")) & near)
    return pairs.select(F.col("h1_a").alias("a"), F.col("h1_b").alias("b"))


def _cluster_pairs(hot: DataFrame, label: DataFrame, classes: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """Pairs of different names that share a frequent signature (or a cluster of
    them) and that sizes and sketches do not rule out."""
    p, q = alike
    hot = materialize(hot.select("g", "h1", "n", F.xxhash64("h1", "band").alias("node")).distinct(), "partenum-hot")
    # a group's cluster is the least node among its members' groups' least members, so
    # the groups around one centre have one cluster; a set may be in several
    least = hot.groupBy("g").agg(F.min("node").alias("least"))
    reach = hot.join(least, "g").groupBy("node").agg(F.min("least").alias("least"))
    cluster = hot.join(reach, "node").groupBy("g").agg(F.min("least").alias("c"))
    members = _labelled(hot.join(cluster, "g").select("h1", "n", "c").distinct(), label)
    mixed = members.groupBy("c").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("c")
    members = members.join(mixed, "c").withColumn("step", F.floor(F.log("n") / math.log(STEP)))
    parts = members.groupBy("c", "step").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    members = members.join(parts, ["c", "step"]).withColumn("block", F.xxhash64("c", "step", F.pmod(F.xxhash64("h1"), F.col("parts"))))
    members = materialize(members.join(classes.select("h1", "cells"), "h1"), "partenum-members")
    blocks = members.groupBy("c", "step", "block").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    one, two = (blocks.select("c", *[F.col(x).alias(f"{x}_{end}") for x in ("step", "block", "low", "high")]) for end in "ab")
    apart = F.col("step_b") - F.col("step_a")
    once = ((apart > 0) & (apart <= math.ceil(math.log(q / p) / math.log(STEP)))) | ((apart == 0) & (F.col("block_a") <= F.col("block_b")))
    alone = (F.col("low_a") == F.col("high_a")) & (F.col("low_b") == F.col("high_b")) & (F.col("low_a") == F.col("low_b"))
    meet = one.join(two, "c").filter(once & ~alone).select("block_a", "block_b")
    sides = [
        meet.select("block_a", "block_b", F.col(f"block_{end}").alias("block"), F.lit(k).alias("side")).join(members.select("block", "h1", "n", "label", "cells"), "block")
        for k, end in enumerate("ab")
    ]
    compared = sides[0].union(sides[1].filter("block_a <> block_b")).drop("block")
    return compared.groupBy("block_a", "block_b").applyInArrow(lambda t: _compare(t, p, q), "a long, b long")


def _compare(table: pa.Table, p: int, q: int) -> pa.Table:
    """Of two blocks (or one with itself): the pairs that may be similar."""
    side = table.column("side").to_numpy()
    h1, n, label = (table.column(c).to_numpy() for c in ("h1", "n", "label"))
    cells = np.frombuffer(b"".join(table.column("cells").to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int16)
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = not len(y)
    y = x if alone else y
    found = []
    for i in range(0, len(x), 64):
        part = x[i : i + 64]
        both = n[part][:, None] + n[y][None]
        able = (label[part][:, None] != label[y][None]) & (np.maximum(n[part][:, None], n[y][None]) * p <= np.minimum(n[part][:, None], n[y][None]) * q)
        if alone:
            able &= h1[part][:, None] < h1[y][None]
        a, b = np.nonzero(able)
        for j in range(0, len(a), 16384):
            r, c = part[a[j : j + 16384]], y[b[j : j + 16384]]
            near = np.abs(cells[r] - cells[c]).sum(1, dtype=np.int64) * (q + p) <= both[a[j : j + 16384], b[j : j + 16384]] * (q - p)
            found.append(np.stack([h1[r[near]], h1[c[near]]], 1))
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pa.table({"a": pa.array(pairs.min(1)), "b": pa.array(pairs.max(1))}) if len(pairs) else pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})


def _without_most_frequent(hot: DataFrame, bands: Bands) -> DataFrame:
    """Frequent signatures without those of each class and band that its spare ones
    pay for. (Sets that emit single features share at least as many of those as
    their overlap, which is more than the spare ones of their band.)"""
    spare = F.element_at(F.array([F.lit(s) for s in bands.spare]), (F.col("band") + 1).cast("int"))
    order = Window.partitionBy("h1", "band").orderBy("m", "g").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("h1", "band")
    out = hot.withColumn("upto", F.sum("times").over(order)).withColumn("all", F.sum("times").over(whole))
    return out.filter(F.col("upto") - F.col("times") < F.col("all") - spare).select(*hot.columns)


def _possible(pairs: DataFrame, classes: DataFrame, alike: tuple[int, int]) -> DataFrame:
    """The pairs that sizes and sketches do not rule out."""
    p, q = alike
    for end in "ab":
        pairs = pairs.join(classes.select(F.col("h1").alias(end), F.col("n").alias(f"n{end}"), F.col("cells").alias(f"c{end}")), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            one, two = (np.frombuffer(b"".join(batch.column(j).to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int16) for j in (4, 5))
            near = np.abs(one - two).sum(1, dtype=np.int64) * (q + p) <= n * (q - p)
            yield pa.RecordBatch.from_arrays([batch.column(j).filter(pa.array(near)) for j in (0, 1)], names=["a", "b"])

    near = F.greatest("na", "nb") * F.lit(p) <= F.least("na", "nb") * F.lit(q)
    return pairs.filter(near).select("a", "b", "na", "nb", "ca", "cb").mapInArrow(run, "a long, b long")


def _sieved(pairs: DataFrame, texts: DataFrame, shingle: int, alike: tuple[int, int]) -> DataFrame:
    """The pairs that fine sketches do not rule out. Their bytes are about a sixth of the
    texts', which only the pairs that pass need."""
    p, q = alike

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = pack(batch.column(1))
            sizes, cells = [], []
            for a, b in chunks(off):
                for features in shingle_sets(data[off[a] : off[b]], off[a : b + 1] - off[a], shingle):
                    sizes.append(len(features))
                    cells.append(fine_sketch(features))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(cells, pa.binary())], names=["h1", "n", "cells"])

    fine = materialize(texts.mapInArrow(sketches, "h1 long, n long, cells binary").dropDuplicates(["h1"]), "partenum-fine")
    for end in "ab":
        pairs = pairs.join(fine.select(F.col("h1").alias(end), F.col("n").alias(f"n{end}"), F.col("cells").alias(f"c{end}")), end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            far = [apart(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5))]
            near = pa.array(np.array(far, np.int64) * (q + p) <= n * (q - p), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(j).filter(near) for j in (0, 1)], names=["a", "b"])

    return pairs.select("a", "b", "na", "nb", "ca", "cb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame, shingle: int, alike: tuple[int, int], sieve: bool = False) -> DataFrame:
    """The pairs ``(a, b)`` of classes whose sets are as similar as asked, from
    their texts. Each class's text is looked up once and sent where it is needed;
    within a task it is cut into shingles once for neighbouring pairs."""
    pairs = materialize(_possible(pairs, classes, alike), "partenum-pairs")
    ends = pairs.select(F.col("a").alias("h1")).union(pairs.select("b")).distinct()
    keys = classes.join(ends, "h1", "left_semi")
    keys = materialize(keys.select(F.col("h1"), F.col("k._ka").alias("_ra"), F.col("k._kb").alias("_rb")), "partenum-keys")
    texts = rows.join(_small(keys), (F.col("_ka") == F.col("_ra")) & (F.col("_kb") == F.col("_rb")))
    texts = materialize(texts.select("h1", "_body"), "partenum-texts")
    if sieve:
        pairs = materialize(_sieved(pairs, texts, shingle, alike), "partenum-sieved")
    # rows equal in id and text share a key: the copies of a text only repeat a pair here
    joined = pairs.join(texts.select(F.col("h1").alias("b"), F.col("_body").alias("tb")), "b")
    joined = joined.join(texts.select(F.col("h1").alias("a"), F.col("_body").alias("ta")), "a")
    p, q = alike

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            a, b = (batch.column(j).to_numpy(zero_copy_only=False) for j in (0, 1))
            data, off = pack(batch.column(3))
            left, loff = pack(batch.column(2))
            keep = np.zeros(batch.num_rows, bool)
            for i, j in chunks(off):
                for r, other in zip(range(i, j), shingle_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], shingle)):
                    if last[0] != a[r]:
                        own = left[loff[r] : loff[r + 1]]
                        last = (a[r], next(shingle_sets(own, np.array([0, len(own)], np.int64), shingle)))
                    both = len(np.intersect1d(last[1], other, assume_unique=True))
                    keep[r] = q * both >= p * (len(last[1]) + len(other) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], names=["a", "b"])

    return joined.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()
