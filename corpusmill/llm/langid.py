"""Language identification with string kernels.

A piece of text is the set of its byte n-grams of lengths 1 to ``MAX_N`` (blended
spectrum, presence only), hashed into ``DIMS`` cells; the kernel of two pieces is
the number of cells both have, over the geometric mean of their numbers. A text
is cut into equal pieces of at most ``PIECE`` bytes, as the cells of a long one
would all be set, and the kernel of two texts is the mean over their pieces. A
Nystroem map on ``LANDMARKS`` landmark texts turns the kernel into vectors, and
one-versus-rest kernel ridge regression is fitted on them. A batch of texts is
scored by two matrix products: texts by landmarks, kernel by weights.

The model is fitted on a bounded sample of the labelled rows
(``ROWS_PER_LANGUAGE`` of each language, chosen by a hash of the row, so the
same rows on any cluster). What reaches the driver is ``DIMS`` half-precision
numbers, compressed, for each of them. Scoring reads every byte of every text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.frames import Shielded
from corpusmill.llm.packed import LOWER, pack

DIMS = 8192
MAX_N = 4
PIECE = 1 << 12  # bytes of text whose n-grams are one set
LANDMARKS = 192
ROWS_PER_LANGUAGE = 600
RIDGE = 1e-2
BATCH = 256  # texts in a matrix product
UNKNOWN = "und"


def presence(texts: list[np.ndarray]) -> np.ndarray:
    """One row of ``DIMS`` flags for each text given as bytes."""
    out = np.zeros((len(texts), DIMS), bool)
    for row, data in zip(out, texts):
        for a in range(0, len(data), 1 << 18):  # pieces overlap by MAX_N - 1, so no n-gram is lost
            low = LOWER[data[a : a + (1 << 18) + MAX_N - 1]]
            code = np.zeros(len(low), np.uint32)
            for n in range(1, MAX_N + 1):
                if len(low) < n:
                    break
                code = (code[: len(low) - n + 1] << np.uint32(8)) | low[n - 1 :]
                cell = (code ^ np.uint32(n * 0x3C6EF35F)) * np.uint32(0x9E3779B1)
                cell ^= cell >> np.uint32(15)
                row[(cell * np.uint32(0x85EBCA6B)) >> np.uint32(19)] = True
    return out


assert DIMS == 1 << 13  # the shift above keeps 13 bits


def vectors(texts: list[np.ndarray]) -> np.ndarray:
    """One row for each text given as bytes: the mean over its pieces of their
    flags, scaled to length one. Kernel values are products of these rows."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for row, data in zip(out, texts):
        size = max(1, -(-len(data) // max(1, -(-len(data) // PIECE))))
        starts = range(0, len(data), size)
        for i in range(0, len(starts), 64):
            flags = presence([data[a : a + size + MAX_N - 1] for a in starts[i : i + 64]])
            row += (1 / np.sqrt(np.maximum(flags.sum(1), 1))).astype(np.float32) @ flags
        row /= max(1, len(starts))
    return out


@dataclass
class Model:
    """Languages, landmark rows and the weights of kernel values."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return (rows @ self.landmarks.T) @ self.weights


def fit(x: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Ridge regression on the Nystroem map of the rows ``x``."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], x[:0], np.zeros((0, 0), np.float32))
    label = np.array([languages.index(x) for x in labels])
    turn = np.zeros(len(label), np.int64)  # landmarks are taken from the languages in turn
    for c in range(len(languages)):
        turn[label == c] = np.arange((label == c).sum())
    chosen = np.argsort(turn, kind="stable")[: min(landmarks, len(label))]
    z = x[chosen]
    value, vector = np.linalg.eigh((z @ z.T).astype(np.float64))
    use = value > 1e-8 * max(value.max(), 1e-12)
    root = vector[:, use] / np.sqrt(value[use])
    features = (x @ z.T).astype(np.float64) @ root
    target = (label[:, None] == np.arange(len(languages))).astype(np.float64)
    weight = 1.0 / np.maximum(target.sum(0), 1)[label]  # every language weighs the same
    weight *= len(label) / weight.sum()
    gram = features.T @ (features * weight[:, None]) + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, features.T @ (target * weight[:, None]))
    return Model(languages, z, (root @ solved).astype(np.float32))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", row_id: str = "doc_id", rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Fits on at most about ``rows_per_language`` rows of each language of ``docs``.

    Rows without text or language teach nothing; no labelled row at all gives a
    model without languages, which predicts ``und`` for everything."""
    rows = docs.select(F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang"), F.col(row_id).alias("_id"))
    rows = rows.filter(F.col("_text").isNotNull() & F.col("_lang").isNotNull())
    counts = {r._lang: r.n for r in rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return fit(np.zeros((0, DIMS), np.float32), [])
    place = F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1_000_003))
    limit = F.lit(0)
    for name, n in counts.items():
        limit = F.when(F.col("_lang") == name, F.lit(int(1_000_003 * min(1.0, rows_per_language / n)))).otherwise(limit)
    sample = rows.filter(place < limit).select(F.col("_text").cast("binary").alias("_text"), "_lang", "_id")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = pack(b.column(0))
            packed: list[bytes] = []
            for i in range(0, b.num_rows, BATCH):
                part = vectors([data[off[j] : off[j + 1]] for j in range(i, min(i + BATCH, b.num_rows))])
                packed += [zlib.compress(r.tobytes(), 1) for r in part.astype(np.float16)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), b.column(1), b.column(2)], names=["row", "_lang", "_id"])

    id_type = sample.schema["_id"].dataType
    schema = T.StructType([T.StructField("row", T.BinaryType()), T.StructField("_lang", T.StringType()), T.StructField("_id", id_type)])
    got = sorted(((r._lang, repr(r._id), bytes(r.row)) for r in sample.mapInArrow(rows_of, schema).collect()))
    if not got:
        return fit(np.zeros((0, DIMS), np.float32), [])
    x = np.empty((len(got), DIMS), np.float32)
    for row, (_, _, b) in zip(x, got):
        row[:] = np.frombuffer(zlib.decompress(b), np.float16)
    return fit(x, [name for name, _, _ in got])


LETTER = regex.compile(r"\p{L}")


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``.

    ``score`` is the winning language's share of the positive regression outputs,
    between 0 and 1. A null text and one without a letter are ``und`` with score
    0, as is everything under a model without languages. Ties go to the language
    that sorts first. Columns of ``docs`` with these names are replaced."""
    side = Shielded(docs)
    body = side.col(text)
    schema = T.StructType([*side.df.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(body))
            data, off = pack(column)
            names: list[str] = []
            shares: list[float] = []
            for a in range(0, batch.num_rows, BATCH):
                b = min(a + BATCH, batch.num_rows)
                part = [data[off[i] : off[i + 1]] for i in range(a, b)]
                spoken = [bool(len(p)) and bool(LETTER.search(p.tobytes().decode("utf-8", "replace"))) for p in part]
                if not m.languages:
                    names += [UNKNOWN] * (b - a)
                    shares += [0.0] * (b - a)
                    continue
                s = np.maximum(m.scores(vectors(part)).astype(np.float64), 0)
                best = s.argmax(1)
                share = s[np.arange(b - a), best] / np.maximum(s.sum(1), 1e-9)
                names += [m.languages[c] if ok else UNKNOWN for c, ok in zip(best, spoken)]
                shares += [float(min(1.0, v)) if ok else 0.0 for v, ok in zip(share, spoken)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(shares, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    out = side.df.mapInArrow(run, schema)
    own = [F.col(c).alias(n) for c, n in zip(side.columns, side.names) if n not in ("lang_pred", "score")]
    return out.select(*own, "lang_pred", "score")


def held_out(row_id: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(row_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def keep_known(docs: DataFrame, model: Model, text: str = "text", min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` with a recognised language, with their columns as they are."""
    side = Shielded(docs)
    out = predict(side.df, model, side.col(text))
    return side.restore(out.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)))
