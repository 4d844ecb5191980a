"""Alignment of two tokenizations of the same bytes, and corpus-wide link counts.

Both tokenizers cut the same bytes. The byte offsets where a token ends map to the
token's index in one dictionary for each side; the offsets in both dictionaries (an
intersection of hash sets), in order, cut the two id lists into groups, and a group
links each of its ids on one side with each on the other.

Texts are cut before single spaces between two visible characters. No token of
either side reaches over such a place (``Aligner`` checks it on the vocabulary of the
second), so what lies between is aligned once and remembered, as prose repeats it: when
``REMEMBERED`` pieces are held, those of one bucket alone make room.

How many documents hold a pair linked is a count over the corpus that every link
needs back. Texts are taken in buckets of ``BUCKET`` bytes in the task that reads
them: a bucket is one row with its different pairs, the number of its documents that
hold each, and the documents' pairs as places in that list. So what is shuffled to be
counted is a row for each pair of a bucket, not of a document; the counts go back the
same way, as one list to a bucket. Whether a count is its id's highest is decided by a
table with a row for each id of the first vocabulary, which bounds its broadcast.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.udf import worker_resource
from corpusmill.session import materialize

REMEMBERED = 300_000
BUCKET = 2 << 20  # bytes of text in a bucket; a longer text is one of its own
JOINED = 1 << 17  # bytes of new pieces encoded at once
SQUARE = 4096  # a group of more links is counted from its different ids
CUT = re.compile(r"(?<=\S)(?= \S)")
SPACE_MARK = "▁"


def byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible
    Latin-1 characters for themselves, the other bytes for those from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def cut_text(said: str) -> list[str]:
    """``said`` (a space and a text) in pieces that start with a space and that both
    tokenizers treat independently."""
    text = said[1:]
    words = text.split()
    if words and len(text) == sum(map(len, words)) + len(words) - 1:  # white space is single throughout
        return [" " + p for p in text.split(" ")]
    return CUT.split(said)


def slices(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The offsets where both sides' tokens end, and how many tokens of each side end by then."""
    at_a = {end: i for i, end in enumerate(ends_a, 1)}
    at_b = {end: i for i, end in enumerate(ends_b, 1)}
    common = sorted(at_a.keys() & at_b.keys())
    return np.array(common, np.int64), *(np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (at_a, at_b))


class Aligner:
    """Two tokenizers and what they made of the pieces met so far."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        chars = byte_chars()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode("utf-8")
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode("utf-8") for i, p in enumerate(names)]
        self.n_b = len(names)
        #: ids as they are said, with what follows inside a group and at its sides' ends
        self.words = [f"{i}{c}" for n, end in ((len(self.bytes_a), "|"), (self.n_b, ";")) for i in range(n) for c in (",", end)]
        #: whether a token can reach over a single space: the first side splits by its
        #: pattern, the second has no piece that holds a space after something else
        split = json.loads(byte_level).get("pre_tokenizer") or {}
        self.whole = not (split.get("type") == "ByteLevel" and split.get("use_regex")) or any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p in names)
        self.length_a, self.length_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # piece -> its number; -1 where its bytes are not kept
        self.said: list[str] = []
        self.sizes = array("q")  # of each piece: ids on both sides, groups, links
        self.first = array("q", [0])  # where each piece's pairs begin in the two below
        self.pairs = array("q")
        self.times = array("q")
        self.met = array("q")  # how many buckets held each piece

    def make_room(self) -> None:
        """Forgets the pieces that one bucket alone held."""
        stay = np.flatnonzero(np.array(self.met, np.int64) > 1)
        if len(stay) > REMEMBERED // 2:
            self.forget()
            return
        names = [""] * len(self.said)
        for piece, k in self.known.items():
            if k >= 0:
                names[k] = piece
        first = np.array(self.first, np.int64)
        n = np.diff(first)[stay]
        inner = _ranges(first[stay], n)
        said, sizes, pairs, times = self.said, self.sizes, self.pairs, self.times
        self.forget()
        self.said = [said[k] for k in stay]
        self.known = {names[k]: i for i, k in enumerate(stay) if names[k]}
        for new, old in ((self.sizes, np.array(sizes, np.int64).reshape(-1, 4)[stay]), (self.pairs, np.array(pairs, np.int64)[inner]), (self.times, np.array(times, np.int64)[inner])):
            new.frombytes(np.ascontiguousarray(old).tobytes())
        self.first.frombytes(np.cumsum(n).astype(np.int64).tobytes())
        self.met.frombytes(np.ones(len(stay), np.int64).tobytes())

    def note(self, used: np.ndarray) -> None:
        """Counts a bucket for its pieces."""
        met = np.zeros(len(self.said), np.int64)
        met[: len(self.met)] = self.met
        met[used] += 1
        self.met = array("q", met.tobytes())

    def encode(self, said: str) -> tuple[list[int], list[int], bool]:
        """Ids on both sides of a space and a text, and whether their bytes are those of ``said``."""
        ids_a = self.a.encode(said, add_special_tokens=False).ids
        ids_b = self.b.encode(said[1:])
        want = said.encode("utf-8")
        kept = b"".join(map(self.bytes_a.__getitem__, ids_a)) == want and b"".join(map(self.bytes_b.__getitem__, ids_b)) == want
        return ids_a, ids_b, kept

    def learn(self, pieces: list[str]) -> None:
        """Aligns pieces that are not known."""
        joined, size = [], 0
        for piece in pieces:
            if len(piece) < 2 or piece[1].isspace() or piece[-1].isspace() or SPACE_MARK in piece:
                self._learn([piece])
                continue
            joined.append(piece)
            size += len(piece)
            if size >= JOINED:
                self._learn(joined)
                joined, size = [], 0
        if joined:
            self._learn(joined)

    def _learn(self, pieces: list[str]) -> None:
        ids_a, ids_b, kept = self.encode("".join(pieces))
        stops = np.cumsum([len(p.encode("utf-8")) for p in pieces])
        if not kept or not self._keep(ids_a, ids_b, stops):
            if len(pieces) == 1:
                self.known[pieces[0]] = -1
                return
            for piece in pieces:
                self._learn([piece])
            return
        self.known.update(zip(pieces, range(len(self.said) - len(pieces), len(self.said))))

    def _keep(self, ids_a: list[int], ids_b: list[int], stops: np.ndarray) -> bool:
        """Takes in the groups of joined pieces that end at the bytes ``stops``; does
        nothing if a token reaches over one of them."""
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        common, to_a, to_b = slices(np.cumsum(self.length_a[a]).tolist(), np.cumsum(self.length_b[b]).tolist())
        last = np.searchsorted(common, stops)  # each piece's last group
        if last[-1] >= len(common) or (common[last] != stops).any():
            return False
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        from_a, from_b = to_a - n_a, to_b - n_b
        bounds = np.r_[0, last + 1]
        links = n_a * n_b
        sizes = np.stack([_sums(n_a, bounds), _sums(n_b, bounds), np.diff(bounds), _sums(links, bounds)], 1)
        of = np.repeat(np.arange(len(stops)), np.diff(bounds))  # each group's piece
        # links: every id of a group's one side with every id of its other
        small = np.flatnonzero(links <= SQUARE)
        g = np.repeat(small, links[small])
        k = _ranges(np.zeros(len(small), np.int64), links[small])
        keys = [a[from_a[g] + k // n_b[g]] * self.n_b + b[from_b[g] + k % n_b[g]]]
        pieces, times = [of[g]], [np.ones(len(g), np.int64)]
        for g in np.flatnonzero(links > SQUARE):
            (x, m), (y, n) = (np.unique(s, return_counts=True) for s in (a[from_a[g] : to_a[g]], b[from_b[g] : to_b[g]]))
            keys.append((x[:, None] * self.n_b + y).ravel())
            times.append((m[:, None] * n).ravel())
            pieces.append(np.full(len(keys[-1]), of[g]))
        key, piece, often = (np.concatenate(x) for x in (keys, pieces, times))
        order = np.lexsort((key, piece))
        key, piece = key[order], piece[order]
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])])
        self.pairs.frombytes(key[start].tobytes())
        self.times.frombytes(np.add.reduceat(often[order], start).tobytes())
        self.sizes.frombytes(np.ascontiguousarray(sizes, np.int64).tobytes())
        self.first.frombytes((self.first[-1] + np.cumsum(np.bincount(piece[start], minlength=len(stops)))).astype(np.int64).tobytes())
        # a group reads a1,a2|b1,b2; with the ids of its one side before those of its other
        said = np.empty(len(a) + len(b), np.int64)
        said[np.arange(len(a)) + np.repeat(from_b, n_a)] = 2 * a
        said[np.arange(len(b)) + np.repeat(to_a, n_b)] = 2 * (len(self.bytes_a) + b)
        said[to_a + from_b - 1] += 1
        said[to_a + to_b - 1] += 1
        words = list(map(self.words.__getitem__, said.tolist()))
        ends = (to_a + to_b)[last].tolist()
        self.said += ["".join(words[i:j]) for i, j in zip([0, *ends], ends)]
        return True

    def place(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the numbers of its pieces; empty where it has no tokens."""
        cut = [([" " + t] if self.whole else cut_text(" " + t)) if t else [] for t in texts]
        new = set().union(*cut) - self.known.keys() if cut else set()
        if len(self.said) + len(new) > REMEMBERED:
            self.make_room()
            new = set().union(*cut) - self.known.keys()
        self.learn(sorted(new))
        out = []
        for text, parts in zip(texts, cut):
            at = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
            if len(at) and at.min() < 0:
                # bytes that one piece loses no other gives back, but the contract is on the whole
                at = self._whole(" " + text)
            out.append(at)
        return out

    def _whole(self, said: str) -> np.ndarray:
        ids_a, ids_b, kept = self.encode(said)
        if not kept:
            return np.zeros(0, np.int64)
        self._keep(ids_a, ids_b, np.array([len(said.encode("utf-8"))]))
        return np.array([len(self.said) - 1])


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs."""
    top = int(values.max(initial=0))
    kind = next(k for k in "BHIQ" if top < 1 << 8 * np.dtype(k).itemsize)
    return kind.encode() + values.astype(kind).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, packed[:1].decode(), offset=1).astype(np.int64)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the stretches ``first[i]`` to ``first[i + 1]``."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, 0, np.int64)])
    return total[first[1:]] - total[first[:-1]]


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first[i]``, ``first[i] + 1``, ... of ``n[i]`` numbers, for each i in turn."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def bucket(aligner: Aligner, texts: list[str], said: bool) -> dict:
    """One bucket's row: facts of each text, and the texts' pairs as places in ``pairs``."""
    at = aligner.place(texts)
    begin = np.cumsum([0, *map(len, at)])
    doc = np.repeat(np.arange(len(at)), np.diff(begin))
    used, piece = np.unique(np.concatenate(at) if at else np.zeros(0, np.int64), return_inverse=True)
    aligner.note(used)
    facts = _sums(np.array(aligner.sizes, np.int64).reshape(-1, 4)[used][piece], begin)
    whole = np.array(aligner.first, np.int64)
    n = whole[used + 1] - whole[used]
    inner = _ranges(whole[used], n)
    pairs, place = np.unique(np.array(aligner.pairs, np.int64)[inner], return_inverse=True)
    times = np.array(aligner.times, np.int64)[inner]
    first = np.cumsum(n) - n
    # pieces of a document, then the pairs of those pieces
    held, often = np.unique(doc * max(1, len(used)) + piece, return_counts=True)
    doc, piece = np.divmod(held, max(1, len(used)))
    n = n[piece]
    inner = _ranges(first[piece], n)
    code = np.repeat(doc, n) * max(1, len(pairs)) + place[inner]
    order = np.argsort(code, kind="stable")
    start = np.flatnonzero(np.r_[True, np.diff(code[order]) > 0]) if len(code) else np.zeros(0, np.int64)
    links = np.add.reduceat((np.repeat(often, n) * times[inner])[order], start) if len(code) else start
    doc, place = np.divmod(code[order][start], max(1, len(pairs)))
    strings = ["".join([aligner.said[k] for k in a.tolist()])[:-1] for a in at]
    return {
        "facts": facts,
        "sha": [hashlib.sha256(s.encode("ascii")).hexdigest() if s else "" for s in strings],
        "said": strings if said else None,
        "pairs": pairs,
        "held": np.bincount(place, minlength=len(pairs)),
        "doc_pairs": _packed(np.bincount(doc, minlength=len(at))),
        "places": _packed(place),
        "links": _packed(links),
    }


FACTS = ("n_a", "n_b", "n_groups", "n_links")


def _buckets(docs: DataFrame, doc_id: str, text: str, byte_level: str, pieces: str, said: bool) -> DataFrame:
    with open(byte_level, "rb") as f, open(pieces, "rb") as g:
        held = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("bucket", T.LongType()), T.StructField("ids", T.ArrayType(source.schema["id"].dataType)), *[T.StructField(n, longs) for n in FACTS],
        T.StructField("sha", T.ArrayType(T.StringType())), *([T.StructField("said", T.ArrayType(T.StringType()))] if said else []), T.StructField("pairs", longs), T.StructField("held", longs),
        T.StructField("doc_pairs", T.BinaryType()), T.StructField("places", T.BinaryType()), T.StructField("links", T.BinaryType()),
    ])
    key = f"align:{byte_level}:{pieces}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        aligner = worker_resource(lambda: Aligner(*held.value), key)
        task, made = TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list[str] = []

        def row() -> pa.RecordBatch:
            nonlocal made
            b = bucket(aligner, texts, said)
            values = {"bucket": task << 32 | made, "ids": ids} | b | {n: b["facts"][:, k] for k, n in enumerate(FACTS)}
            made += 1
            return pa.RecordBatch.from_arrays([pa.array([values[f.name]], f.type) for f in arrow], schema=arrow)

        size = 0
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    t = t or ""
                    if texts and size + len(t) > BUCKET:
                        yield row()
                        ids, texts, size = [], [], 0
                    ids.append(i)
                    texts.append(t)
                    size += len(t) + 64
        if texts:
            yield row()

    return source.mapInArrow(run, schema)


def align(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text", said: bool = False) -> DataFrame:
    """A row for each row of ``docs``: its id, ``n_a`` and ``n_b`` ids, ``n_groups``,
    ``n_links``, ``n_best`` (links whose count is the highest of their first id), ``count_sum``
    (the counts of all links) and ``groups_sha256``; with ``said`` also ``groups``, the
    text that is hashed: ``a1,a2|b1;a3|b2,b3``.

    A pair's count is the number of rows of ``docs`` that hold it linked, so repeated
    rows count each. A text is encoded with a space before it, by the byte-level
    tokenizer in ``byte_level`` and the piece tokenizer in ``pieces`` (file names, read on
    the driver and broadcast; vocabularies are of fixed size). Null and empty texts,
    and those whose bytes a tokenizer does not keep, have no tokens: zeros and an empty
    string. Null and repeated ids stay as they are, an empty table gives an empty
    result, other columns are not looked at. Runs jobs when it is called; its steps are
    written to the shared checkpoint folder."""
    parts = materialize(_buckets(docs, doc_id, text, byte_level, pieces, said), "align-buckets")
    with open(pieces, "rb") as g:
        import sentencepiece

        n_b = sentencepiece.SentencePieceProcessor(model_proto=g.read()).get_piece_size()
    each = parts.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("p.pairs", "p.held")
    counts = materialize(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n")), "align-counts")
    counts = counts.withColumn("a", F.expr(f"pair div {n_b}"))
    highest = counts.groupBy("a").agg(F.max("n").alias("top"))
    judged = counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    asked = parts.select("bucket", F.posexplode("pairs").alias("place", "pair"))
    told = asked.join(judged, "pair").groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("told"))
    told = told.select("bucket", F.col("told.n").alias("n"), F.col("told.best").alias("best"))
    side = parts.drop("pairs", "held").join(told, "bucket", "left")
    id_type = parts.schema["ids"].dataType.elementType
    names = [*FACTS, "n_best", "count_sum"]
    out = T.StructType([T.StructField(doc_id, id_type), *[T.StructField(n, T.LongType()) for n in names], T.StructField("groups_sha256", T.StringType()), *([T.StructField("groups", T.StringType())] if said else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in batches:
            for k in range(batch.num_rows):
                got = {f: batch.column(f)[k] for f in batch.schema.names}
                doc_pairs, place, links = (_unpacked(got[c].as_py()) for c in ("doc_pairs", "places", "links"))
                first = np.r_[0, np.cumsum(doc_pairs)]
                if len(place):
                    n = got["n"].values.to_numpy(zero_copy_only=False)[place]
                    best = got["best"].values.to_numpy(zero_copy_only=False)[place]
                else:
                    n, best = place, place.astype(bool)
                sums = [pa.array(_sums(links * x, first)) for x in (best, n)]
                columns = [got["ids"].values, *[got[c].values for c in FACTS], *sums, got["sha"].values]
                yield pa.RecordBatch.from_arrays([*columns, *([got["said"].values] if said else [])], schema=arrow)

    return side.mapInArrow(run, out)
