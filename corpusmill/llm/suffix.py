"""Removal of repeated byte strings with per-shard suffix arrays.

Every string of ``LENGTH`` bytes that starts at two or more places of the corpus
goes, wherever it occurs.

1. Anchors. Of the ``GRAM``-byte hashes inside a window of ``LENGTH`` bytes the
   smallest (leftmost of equals) is the window's anchor. Equal windows have equal
   anchors, and neighbouring windows mostly share one, so a text has an anchor for
   about every 75 bytes. A window can only repeat if its anchor's hash does: the
   hashes are counted over the corpus and the rest of the text is out.
2. Shards. For each repeated anchor the bytes of its windows (a segment) go to the
   shard of its hash, so windows that can be equal meet in one shard. A hash with
   more than ``SHARD_SEGMENTS`` segments is dealt over several shards.
3. In a shard, equal segments are laid together. Of the segments of a hash that
   differ, those that share too little with any other on the two sides of the
   anchor are out, and the rest is sorted by all its suffixes (Larsson-Sadakane: ranks refined by
   doubling, only groups that are still tied are sorted again, numpy), Kasai's
   algorithm gives the common prefixes of neighbours, and a window whose common
   prefix with a neighbour reaches ``LENGTH`` is repeated.
4. Shards of one hash are merged: each sends its windows that are alone there,
   and one of each that is not, as 128-bit fingerprints in sorted runs; a
   window of one run that binary search finds in another is repeated.

No step holds more than a shard of bounded size, and copies of a text are
compared as equal segments, not pair by pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.frames import Shielded, row_key
from corpusmill.llm.packed import CHUNK, mix, pack, powers
from corpusmill.session import materialize

LENGTH = 200
GRAM = 48
SHARD_SEGMENTS = 4096
TASK_SEGMENTS = 8192  # segments of unsplit hashes in one group
RUN_WINDOWS = 500_000  # fingerprints in one group of the merge
BROADCAST_ROWS = 200_000
BROADCAST_SPANS = 1_000_000


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one byte array: each anchor's hash, the first window start it holds for,
    its place in that window, and the number of windows in a row that it holds for."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    h = gram_hashes(data, gram)
    # 40 bits of hash and the place: the smallest of a window is its leftmost smallest hash
    low = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    width, have = length - gram + 1, 1
    least = low
    while have * 2 <= width:
        least = np.minimum(least[: len(least) - have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return h[at[first]], first, at[first] - first, np.diff(np.r_[first, n])


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return mix((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])


def text_anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``anchors`` of a text of any size, worked on in pieces that overlap."""
    if len(data) <= CHUNK:
        return anchors(data, length, gram)
    parts = []
    for a in range(0, len(data) - length + 1, CHUNK):
        h, first, place, run = anchors(data[a : a + CHUNK + length - 1], length, gram)
        parts.append((h, first + a, place, run))
    return tuple(np.concatenate(x) for x in zip(*parts))


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Places of ``codes`` (bytes plus 1, 0 after each segment) in the order of their
    suffixes.

    Larsson-Sadakane: sorted by seven codes first; then a suffix's key is its own
    rank and the rank of the place as many codes on as are sorted already, and
    only groups that are still tied are refined."""
    n = len(codes)
    ahead = np.r_[codes, np.zeros(7, codes.dtype)].astype(np.uint64)
    packed = np.zeros(n, np.uint64)
    for j in range(7):  # nine bits a code
        packed = (packed << np.uint64(9)) | ahead[j : j + n]
    order = np.argsort(packed, kind="stable")
    packed = packed[order]
    start = np.r_[True, packed[1:] != packed[:-1]]
    rank = np.zeros(n + 1, np.int64)  # the last is the end of the text
    have = 7
    while True:
        head = np.flatnonzero(start)
        size = np.diff(np.r_[head, n])
        rank[order] = np.repeat(head, size) + 1
        slots = np.flatnonzero(np.repeat(size > 1, size))
        if not len(slots):
            return order
        at = order[slots]
        after, own = rank[np.minimum(at + have, n)], rank[at]
        again = np.lexsort((after, own))  # groups keep their slots: own ranks are in order already
        order[slots] = at[again]
        own, after = own[again], after[again]
        start[slots] |= np.r_[True, (own[1:] != own[:-1]) | (after[1:] != after[:-1])]
        have *= 2


def common_prefixes(codes: np.ndarray, order: np.ndarray, begin: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
    """Kasai's algorithm: for each slot of ``order`` the length of the common prefix
    with the slot before it, up to ``limit`` codes and within a segment.

    A suffix's common prefix is at least that of the suffix one place before it
    less one. The segments are walked side by side, one comparison of each in a
    step."""
    n = len(order)
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    padded = np.r_[codes, np.zeros(limit + 1, codes.dtype)]
    prefix = np.zeros(n, np.int64)
    place, have = begin.copy(), np.zeros(len(begin), np.int64)
    stop = end.copy()
    while len(place):
        mine = slot[place]
        other = order[np.maximum(mine - 1, 0)]
        a = padded[place + have]
        equal = (mine > 0) & (a != 0) & (a == padded[other + have]) & (have < limit)
        have[equal] += 1
        done = ~equal
        prefix[mine[done]] = have[done]
        place[done] += 1
        have[done] = np.maximum(have[done] - 1, 0)
        live = place < stop
        if not live.all():
            place, have, stop = place[live], have[live], stop[live]
    return prefix


def repeated_windows(segments: list[bytes], length: int) -> list[np.ndarray]:
    """For each of some different segments, whether the window at each of its
    starts also occurs at another place of them."""
    lengths = np.array([len(s) for s in segments], np.int64)
    begin = np.cumsum(np.r_[0, lengths[:-1] + 1])
    codes = np.zeros(int(lengths.sum()) + len(segments), np.int16)
    for b, s in zip(begin, segments):
        codes[b : b + len(s)] = np.frombuffer(s, np.uint8)
    inside = np.ones(len(codes), bool)
    inside[begin + lengths] = False
    codes[inside] += 1
    order = suffix_array(codes)
    prefix = common_prefixes(codes, order, begin, begin + lengths, length)
    near = prefix >= length
    hit = np.zeros(len(codes), bool)
    hit[order[near | np.r_[near[1:], False]]] = True
    return [hit[b : b + n - length + 1] for b, n in zip(begin, lengths)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edge[::2], edge[1::2]


def fingerprints(segment: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each window of a segment."""
    one = gram_hashes(segment, length)
    return one, gram_hashes(segment[::-1], length)[::-1] ^ mix(one)


SPANS = "_ka long, _kb long, start long, stop long, f1 long, f2 long, shard long"


def _reach(contexts: list[bytes], h: np.ndarray, width: int) -> np.ndarray:
    """For each context the longest prefix it shares with another one of its hash."""
    n = len(contexts)
    text = b"".join(c[:width].replace(b"\0", b"\xff").ljust(width, b"\0") for c in contexts)  # UTF-8 has no byte 255
    group = np.unique(h, return_inverse=True)[1]
    digits = np.stack([group // 255**j % 255 + 1 for j in (3, 2, 1, 0)], 1).astype(np.uint8)  # no zero: it would end a key
    rows = np.concatenate([digits, np.frombuffer(text, np.uint8).reshape(n, width)], 1)
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width + 4}").ravel(), kind="stable")
    rows, sorted_h = rows[order, 4:], h[order]
    same = (rows[1:] == rows[:-1]) & (rows[1:] != 0)
    shared = np.where(same.all(1), width, same.argmin(1)) * (sorted_h[1:] == sorted_h[:-1])
    best = np.maximum(np.r_[shared, 0], np.r_[0, shared])
    out = np.empty(n, np.int64)
    out[order] = best
    return out


def _shard(table: pa.Table, length: int, gram: int) -> pa.Table:
    """Repeated spans of a shard's windows; for a split hash also the fingerprints
    that the merge needs (start -1 for a window that is settled here)."""
    h = table.column("h").to_numpy()
    order = np.argsort(h, kind="stable")
    ka, kb, at, place, split, shard = (table.column(c).to_numpy()[order] for c in ("_ka", "_kb", "at", "place", "split", "shard"))
    h = h[order]
    body = table.column("segment").to_pylist()
    bodies = [body[i] for i in order]
    head = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True])
    out: list[list] = [[] for _ in range(7)]

    def put(rows, starts, stops, one=None, two=None):
        k = len(starts)
        for column, value in zip(out, (ka[rows], kb[rows], starts, stops, one if one is not None else np.zeros(k, np.int64), two if two is not None else np.zeros(k, np.int64), shard[rows])):
            column.append(np.broadcast_to(value, (k,)))

    mixed: list[bytes] = []
    members: list[list[int]] = []
    for a, b in zip(head[:-1], head[1:]):
        same: dict[bytes, list[int]] = {}
        for i in range(a, b):
            same.setdefault(bodies[i], []).append(i)
        if len(same) == 1 and b - a > 1 and not split[a]:
            rows = np.arange(a, b)
            put(rows, at[rows], at[rows] + len(bodies[a]))
            continue
        for segment, rows in same.items():
            mixed.append(segment)
            members.append(rows)
    settled: list[tuple[np.ndarray, np.ndarray]] = []
    hits: dict[int, np.ndarray] = {}
    if mixed:
        # what a segment shares with others on both sides of the anchor must make up a window
        lead = np.array([rows[0] for rows in members])
        width = length - gram
        left = _reach([m[: place[i]][::-1] for m, i in zip(mixed, lead)], h[lead], width)
        right = _reach([m[place[i] + gram :] for m, i in zip(mixed, lead)], h[lead], width)
        able = np.flatnonzero(left + right >= width)
        hits = dict(zip(able.tolist(), repeated_windows([mixed[i] for i in able], length) if len(able) else []))
    for k, (segment, rows) in enumerate(zip(mixed, members)):
        flags = hits.get(k, np.zeros(len(segment) - length + 1, bool)) | (len(rows) > 1)
        rows = np.array(rows)
        starts, stops = _runs(flags)
        for s, e in zip(starts, stops):
            put(rows, at[rows] + s, at[rows] + e - 1 + length)
        if split[rows[0]]:
            one, two = (x.view(np.int64) for x in fingerprints(np.frombuffer(segment, np.uint8), length))
            alone = np.flatnonzero(~flags)
            put(np.repeat(rows[0], len(alone)), at[rows[0]] + alone, at[rows[0]] + alone + length, one[alone], two[alone])
            settled.append((one[flags], two[flags]))
    if settled:  # one of each window that is settled here, for the other shards of its hash
        pairs = np.unique(np.stack([np.concatenate([x[j] for x in settled]) for j in (0, 1)], 1), axis=0)
        put(np.zeros(len(pairs), np.int64), np.full(len(pairs), -1), np.full(len(pairs), -1), pairs[:, 0], pairs[:, 1])
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
    names = ["_ka", "_kb", "start", "stop", "f1", "f2", "shard"]
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(names, columns)})


def _merge(table: pa.Table) -> pa.Table:
    """The windows of sorted runs, one of each shard, that another run has too."""
    kind = np.dtype([("a", np.int64), ("b", np.int64)])
    f = np.empty(table.num_rows, kind)
    f["a"], f["b"] = table.column("f1").to_numpy(), table.column("f2").to_numpy()
    shard = table.column("shard").to_numpy()
    start = table.column("start").to_numpy()
    by_shard = np.argsort(shard, kind="stable")
    edge = np.flatnonzero(np.r_[True, np.diff(shard[by_shard]) != 0, True])
    every = np.sort(f, order=("a", "b"))
    hit = np.zeros(table.num_rows, bool)
    for a, b in zip(edge[:-1], edge[1:]):
        rows = by_shard[a:b]
        run = f[rows][np.argsort(f[rows], order=("a", "b"))]
        mine = f[rows]
        others = (_place(every, mine, "right") - _place(every, mine, "left")) > (_place(run, mine, "right") - _place(run, mine, "left"))
        hit[rows] = others & (start[rows] >= 0)
    return table.select(["_ka", "_kb", "start", "stop"]).filter(pa.array(hit))


def _place(run: np.ndarray, keys: np.ndarray, side: str) -> np.ndarray:
    """Binary search of two-part keys: by the first part, then (for the few equal
    ones) by the second."""
    low, high = np.searchsorted(run["a"], keys["a"], "left"), np.searchsorted(run["a"], keys["a"], "right")
    out = low.copy()
    for i in np.flatnonzero(high > low):
        out[i] += np.searchsorted(run["b"][low[i] : high[i]], keys["b"][i], side)
    return out


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_segments: int = SHARD_SEGMENTS) -> DataFrame:
    """``(_ka, _kb, start, stop)``: byte spans of ``rows`` (``_ka``, ``_kb``,
    ``_body``) whose every window repeats; spans of a row may overlap."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, off = pack(batch.column(2))
            parts = [text_anchors(data[off[i] : off[i + 1]], length, gram) for i in range(batch.num_rows)]
            counts = [len(p[0]) for p in parts]
            ka, kb = (np.repeat(batch.column(j).to_numpy(), counts) for j in (0, 1))
            h, first, place, run = (np.concatenate([p[j] for p in parts]) for j in range(4))
            yield pa.RecordBatch.from_arrays([pa.array(ka), pa.array(kb), pa.array(h.view(np.int64)), pa.array(first << 16 | place << 8 | run)], names=["_ka", "_kb", "h", "at"])

    assert length - gram + 1 < 256  # an anchor's place and its number of windows fit a byte each
    found = rows.filter(F.octet_length("_body") >= length).mapInArrow(find, "_ka long, _kb long, h long, at long")
    found = materialize(found, "suffix-anchors")
    often = found.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    marks = found.join(often, "h").withColumn("parts", F.ceil(F.col("c") / shard_segments).cast("int"))
    marks = materialize(
        marks.groupBy("_ka", "_kb").agg(F.collect_list(F.struct("h", "at", "parts")).alias("marks"), F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("parts") > 1, 1).otherwise(0)).alias("hot")),
        "suffix-marks",
    )
    sums = marks.agg(F.sum("n").alias("n"), F.sum("hot").alias("hot")).first()
    shards = int(sums.n or 0) // TASK_SEGMENTS + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = pack(batch.column(2))
            lists = batch.column(3)
            flat = lists.flatten()
            h, at, parts = (flat.field(j).to_numpy() for j in range(3))
            edge = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(edge))
            first, place, run = at >> 16, at >> 8 & 255, at & 255
            salt = (mix((batch.column(0).to_numpy()[owner] ^ at).view(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
            plain = (mix(h.view(np.uint64)) % np.uint64(shards)).view(np.int64)
            own = -1 - (mix(h.view(np.uint64) + salt.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(2)).view(np.int64)
            shard = np.where(parts > 1, own, plain)
            begin = off[owner] + first
            size = run - 1 + length
            for a in range(0, len(h), 8192):
                b = min(a + 8192, len(h))
                bodies = [data[s : s + n].tobytes() for s, n in zip(begin[a:b].tolist(), size[a:b].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x[a:b]) for x in (batch.column(0).to_numpy()[owner], batch.column(1).to_numpy()[owner], h, first, place, shard)], pa.array(parts[a:b] > 1), pa.array(bodies, pa.binary())],
                    names=["_ka", "_kb", "h", "at", "place", "shard", "split", "segment"],
                )

    carried = rows.join(marks.select("_ka", "_kb", "marks"), ["_ka", "_kb"]).select("_ka", "_kb", "_body", "marks")
    segments = carried.mapInArrow(cut, "_ka long, _kb long, h long, at long, place long, shard long, split boolean, segment binary")
    spans = materialize(segments.groupBy("shard").applyInArrow(lambda t: _shard(t, length, gram), SPANS), "suffix-spans")
    own = spans.filter("f1 = 0 and f2 = 0").select("_ka", "_kb", "start", "stop")
    if not sums.hot:
        return own
    runs = int(sums.hot) * (length - gram) // 2 // RUN_WINDOWS + 1
    open_windows = spans.filter("f1 <> 0 or f2 <> 0").withColumn("run", F.pmod(F.xxhash64("f1"), F.lit(runs)))
    merged = open_windows.groupBy("run").applyInArrow(_merge, "_ka long, _kb long, start long, stop long")
    return own.union(merged)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's spans as maximal runs: their starts and stops in order."""
    for batch in batches:
        lists = batch.column(2)
        flat = lists.flatten()
        start, stop = (flat.field(j).to_numpy() for j in (0, 1))
        owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
        order = np.lexsort((start, owner))
        owner, start, stop = owner[order], start[order], stop[order]
        width = int(stop.max(initial=0)) + 2  # texts end to end, apart from each other
        reach = np.maximum.accumulate(stop + owner * width) if len(owner) else stop
        new = np.r_[True, start[1:] + owner[1:] * width > reach[:-1]] if len(owner) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(owner)] - 1
        edge = pa.array(np.searchsorted(owner[first], np.arange(batch.num_rows + 1)).astype(np.int32))
        starts, stops = start[first], (reach - owner * width)[last] if len(owner) else stop
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *[pa.ListArray.from_arrays(edge, pa.array(x.astype(np.int64))) for x in (starts, stops)]],
            names=["_sa", "_sb", "starts", "stops"],
        )


def remove_repeats(docs: DataFrame, text: str = "text", row_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, shard_segments: int = SHARD_SEGMENTS, contents: bool = True) -> DataFrame:
    """``docs`` plus ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_bytes`` (what remains, which may cut a character; left out with
    ``contents=False``) and ``kept_sha256``.

    Strings are judged on the input texts in UTF-8; a null text is empty, and texts
    shorter than ``length`` bytes lose nothing. Rows equal in id and text repeat
    each other, so both lose every string of ``length`` bytes. An empty table gives
    an empty result. Columns of ``docs`` with the names of the new ones are
    replaced. The search runs when this is called, writing its steps to the shared
    checkpoint folder; the removal is lazy."""
    side = Shielded(docs)
    rid, body = side.col(row_id), side.col(text)
    keyed = side.df.withColumn(body, F.col(body).cast("string")).select(*side.columns, *row_key(rid, body))
    texts = keyed.select("_ka", "_kb", F.coalesce(F.col(body), F.lit("")).cast("binary").alias("_body"))
    spans = repeated_spans(texts, length, gram, shard_segments)
    spans = spans.groupBy("_ka", "_kb").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    spans = materialize(spans.mapInArrow(_merged, "_sa long, _sb long, starts array<long>, stops array<long>"), "suffix-removed")
    size = spans.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("starts")).alias("spans")).first()
    if size.rows <= BROADCAST_ROWS and (size.spans or 0) <= BROADCAST_SPANS:
        spans = F.broadcast(spans)
    joined = keyed.join(spans, (F.col("_ka") == F.col("_sa")) & (F.col("_kb") == F.col("_sb")), "left")
    new = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept_sha256": T.StringType()}
    if contents:
        new["kept_bytes"] = T.BinaryType()

    own, side_at = len(side.columns), side.columns.index(body)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = pack(batch.column(side_at))
            starts, stops = batch.column(own), batch.column(own + 1)
            edge = np.r_[0, np.cumsum(starts.value_lengths().fill_null(0).to_numpy())]
            start, stop = starts.flatten().to_numpy(), stops.flatten().to_numpy()
            out: list[list] = [[] for _ in range(5)]
            for i in range(batch.num_rows):
                mine = data[off[i] : off[i + 1]]
                a, b = edge[i], edge[i + 1]
                removed = int((stop[a:b] - start[a:b]).sum())
                kept = mine.tobytes()
                if removed:
                    kept = b"".join(kept[x:y] for x, y in zip([0, *stop[a:b].tolist()], [*start[a:b].tolist(), len(kept)]))
                for column, value in zip(out, (len(mine), removed, int(b - a), hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(value)
            columns = [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:own], *columns[: len(new)]], names=[*batch.schema.names[:own], *new])

    schema = T.StructType([*keyed.select(*side.columns).schema.fields, *[T.StructField(n, t) for n, t in new.items()]])
    done = joined.select(*side.columns, "starts", "stops").mapInArrow(cut, schema)
    kept = [F.col(c).alias(n) for c, n in zip(side.columns, side.names) if n not in new]
    return done.select(*kept, *new)
