"""Quality scores from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each text. Their
accuracies are not known; expectation-maximisation finds them together with the
share of good texts, from how often each combination of votes occurs (a table of
at most 3 ** labellers rows, counted over all texts). The posterior of each
combination is the weak label, and a linear scorer over hashed words, word ends and
pairs of byte classes is trained on the weak labels of a bounded sample, so that it
can also judge texts on which the labellers are silent.

The sample for the scorer is ``SAMPLE_ROWS`` rows at most, chosen by a hash of
the row; votes, vote counts and scores cover every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.frames import Shielded
from corpusmill.llm.packed import Words, chunks, pack, table

CELLS = 1 << 14
SAMPLE_ROWS = 4000
EPOCHS = 60
PENALTY = 1e-3

#: Words for the labellers are runs of bytes above the space character.
VISIBLE = table(bytes(range(0x21, 0x100)))
LETTERS = table(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))
CAPITALS = table(bytes(range(0x41, 0x5B)))
DIGITS = table(bytes(range(0x30, 0x3A)))
MARKS = table(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
ORDINARY_MARKS = table(b".,;:'\"?()-")
ENDING = table(b".!?:;\"')")
#: classes of bytes: other control, newline, blank, small, capital, digit, ordinary mark, odd mark, beyond ASCII
CLASSES = 9
CLASS = np.zeros(256, np.uint8)
for _i, _bytes in enumerate((b"\n\r", b" \t", range(0x61, 0x7B), range(0x41, 0x5B), range(0x30, 0x3A), b".,;:'\"?()-", np.flatnonzero(MARKS & ~ORDINARY_MARKS), range(0x80, 0x100)), 1):
    CLASS[list(_bytes)] = _i
PAIRS = CLASSES * CLASSES

#: name -> (bad at least this, good at most this); bad is high for all
LABELLERS = {
    "odd_marks": (0.06, 0.01),  # marks other than ordinary punctuation, a byte
    "marks": (0.15, 0.06),  # all marks, a byte
    "capitals": (0.30, 0.08),  # capitals, an ASCII letter
    "digits": (0.15, 0.02),  # digits, a byte
    "open_lines": (0.70, 0.30),  # lines that do not end in punctuation, a line
    "odd_words": (0.30, 0.05),  # words that end in an odd mark, a word
    "long_words": (0.25, 0.08),  # words of more than 15 bytes, a word
    "same_words": (0.85, 0.60),  # words that occurred before, a word
    "few_words": (0.05, 0.02),  # one over the number of words
}


def measures(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, Words]:
    """A row for each text with a value for each labeller."""
    words = Words(data, off, VISIBLE)
    n = len(off) - 1

    def total(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(flags)]
        return (sums[at[1:]] - sums[at[:-1]]).astype(np.float64)

    size = np.maximum(np.diff(off), 1)
    count = np.maximum(np.diff(words.first), 1)
    odd = MARKS[data] & ~ORDINARY_MARKS[data]
    ascii_letters = total(LETTERS[data] & (data < 0x80), off)
    last = words.end - 1
    breaks = np.flatnonzero(data == 10)
    line_ends = np.unique(np.r_[breaks, off[1:]])  # a text's end closes its last line
    before = line_ends - 1
    ok = (before >= 0) & (line_ends > 0)
    ok[ok] &= data[before[ok]] != 10
    owner = np.clip(np.searchsorted(off, before[ok], "right") - 1, 0, max(n - 1, 0))
    lines = np.bincount(owner, minlength=n)[:n] if n else np.zeros(0)
    open_lines = np.bincount(owner, ~ENDING[data[before[ok]]], minlength=n)[:n] if n else np.zeros(0)
    key = words.hash ^ (words.doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    values = [
        total(odd, off) / size,
        total(MARKS[data], off) / size,
        total(CAPITALS[data], off) / np.maximum(ascii_letters, 1),
        total(DIGITS[data], off) / size,
        open_lines / np.maximum(lines, 1),
        total(odd[last], words.first) / count,
        total((words.end - words.start) > 15, words.first) / count,
        total(again, words.first) / count,
        1.0 / count,
    ]
    return np.stack(values, 1), words


def votes(values: np.ndarray) -> np.ndarray:
    """1 good, 0 bad, 2 nothing; an empty text is bad to the last labeller and
    nothing to the rest."""
    limits = np.array(list(LABELLERS.values()))
    return np.where(values >= limits[:, 0], 0, np.where(values <= limits[:, 1], 1, 2)).astype(np.int8)


def patterns(v: np.ndarray) -> np.ndarray:
    """Each row's votes as one number."""
    return v.astype(np.int64) @ (3 ** np.arange(v.shape[1], dtype=np.int64))


@dataclass
class WeakLabels:
    """Share of good texts, and for each labeller the chances of its votes
    (bad, good, nothing) given a bad and a good text."""

    good: float
    chances: np.ndarray  # labeller, class, vote

    def posterior(self, v: np.ndarray) -> np.ndarray:
        log = np.log(np.array([1 - self.good, self.good]))[None, :].repeat(len(v), 0)
        for j in range(v.shape[1]):
            log += np.log(self.chances[j][:, v[:, j]]).T
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))


def estimate(v: np.ndarray, times: np.ndarray, rounds: int = 200) -> WeakLabels:
    """Expectation-maximisation over distinct vote rows and how often they occur."""
    j = v.shape[1]
    chances = np.empty((j, 2, 3))
    chances[:, 0], chances[:, 1] = (0.5, 0.2, 0.3), (0.1, 0.6, 0.3)  # better than chance: names the classes
    model = WeakLabels(0.8, chances)
    if not len(v):
        return model
    times = times.astype(np.float64)
    for _ in range(rounds):
        p = model.posterior(v)
        weight = np.stack([(1 - p) * times, p * times])
        new = np.empty_like(chances)
        for k in range(j):
            for vote in range(3):
                new[k, :, vote] = weight[:, v[:, k] == vote].sum(1) + 1.0
        new /= new.sum(2, keepdims=True)
        good = float(np.clip(weight[1].sum() / times.sum(), 0.01, 0.99))
        still = abs(good - model.good) < 1e-9 and np.abs(new - model.chances).max() < 1e-9
        model = WeakLabels(good, new)
        if still:
            break
    return model


def features(data: np.ndarray, off: np.ndarray, values: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of each text as (text, cell, weight): its words, their last
    three bytes, its pairs of neighbouring byte classes, and the labellers' measures
    in steps. Each kind sums to one, each measure too."""
    n = len(off) - 1
    share = 1.0 / np.maximum(np.diff(words.first), 1)[words.doc]
    whole = (words.hash >> np.uint64(50)).astype(np.int64)  # 14 bits
    tail = np.zeros(len(words.end), np.uint32)
    for back in range(3):
        at = np.maximum(words.end - 1 - back, words.start)
        tail = tail * np.uint32(257) + data[at]
    cell = (tail * np.uint32(0x9E3779B1)) >> np.uint32(18)  # 14 bits
    parts = [(words.doc, whole, share), (words.doc, CELLS + cell.astype(np.int64), share)]
    # pairs of classes are counted a text at once: at most PAIRS of them each
    kind = CLASS[data]
    pair = kind[:-1] * np.uint8(CLASSES) + kind[1:]
    owner = np.repeat(np.arange(n, dtype=np.int32), np.diff(off))
    inside = owner[:-1] == owner[1:]
    of = owner[:-1][inside].astype(np.int64) * PAIRS + pair[inside]
    times = np.bincount(of, minlength=n * PAIRS).reshape(n, PAIRS) if n else np.zeros((0, PAIRS))
    at, which = np.nonzero(times)
    parts.append((at, 2 * CELLS + which, times[at, which] / np.maximum(times.sum(1), 1)[at]))
    step = np.minimum((values * 40).astype(np.int64), 39)
    own = 2 * CELLS + PAIRS + np.arange(values.shape[1]) * 40 + step
    parts.append((np.repeat(np.arange(n), values.shape[1]), own.ravel(), np.full(own.size, 1.0)))
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


WIDTH = 2 * CELLS + PAIRS + 40 * len(LABELLERS)


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def __call__(self, n: int, rows: np.ndarray, cells: np.ndarray, amounts: np.ndarray) -> np.ndarray:
        z = np.bincount(rows, self.weights[cells] * amounts, minlength=n)[:n] + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def train_scorer(n: int, rows: np.ndarray, cells: np.ndarray, amounts: np.ndarray, target: np.ndarray) -> Scorer:
    """Logistic regression on soft targets by accelerated gradient steps."""
    weights, bias = np.zeros(WIDTH), 0.0
    if not n:
        return Scorer(weights, bias)
    moved, last, rate = weights.copy(), weights.copy(), 2.0
    for t in range(EPOCHS):
        p = Scorer(moved, bias)(n, rows, cells, amounts)
        error = p - target
        gradient = np.bincount(cells, error[rows] * amounts, minlength=WIDTH) / n + PENALTY * moved
        weights = moved - rate * gradient
        bias -= rate * error.mean()
        moved = weights + t / (t + 3) * (weights - last)
        last = weights
    return Scorer(weights, bias)


def quality(docs: DataFrame, text: str = "text", row_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` plus ``votes`` (a digit for each labeller: 1 good, 0 bad, 2 nothing),
    ``weak_label`` (posterior of good given the votes), ``score`` (of the trained
    scorer, 0 to 1) and ``good`` (score of at least one half).

    Null and empty texts have no words and score 0. Repeated rows get equal
    results. An empty table gives an empty result. Columns of ``docs`` with the
    names of the new ones are replaced. Estimation and training run when this is
    called; what reaches the driver is the vote table and the sample's features."""
    side = Shielded(docs)
    rid, body = side.col(row_id), side.col(text)
    spark = docs.sparkSession
    texts = side.df.select(F.col(body).cast("string").alias("t"), F.pmod(F.xxhash64(F.lit("sample"), F.col(rid), F.col(body)), F.lit(1_000_003)).alias("place"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = pack(batch.column(0))
            got = [patterns(votes(measures(data[off[a] : off[b]], off[a : b + 1] - off[a])[0])) for a, b in chunks(off)]
            counted, times = np.unique(np.concatenate(got) if got else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(counted, pa.int64()), pa.array(times, pa.int64())], names=["pattern", "times"])

    table_ = texts.select("t").mapInArrow(vote, "pattern long, times long").groupBy("pattern").agg(F.sum("times").alias("times"))
    counted = sorted((r.pattern, r.times) for r in table_.collect())  # at most 3 ** labellers rows
    total = sum(t for _, t in counted)
    digits = np.array([[p // 3**j % 3 for j in range(len(LABELLERS))] for p, _ in counted], np.int8).reshape(-1, len(LABELLERS))
    labels = estimate(digits, np.array([t for _, t in counted]))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = pack(batch.column(0))
            out: list[list] = [[], [], [], []]
            for a, b in chunks(off):
                part, at = data[off[a] : off[b]], off[a : b + 1] - off[a]
                values, words = measures(part, at)
                rows, cells, amounts = features(part, at, values, words)
                p = labels.posterior(votes(values))
                for i in range(b - a):
                    own = rows == i
                    cell, where = np.unique(cells[own], return_inverse=True)
                    for column, v in zip(out, (batch.column(1)[a + i].as_py(), p[i], cell.tolist(), np.bincount(where, amounts[own]).tolist())):
                        column.append(v)
            kinds = (pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["place", "p", "cells", "amounts"])

    limit = int(1_000_003 * min(1.0, sample_rows / max(total, 1)))
    sample = texts.filter((F.col("place") < limit) & (F.length("t") > 0))
    got = sorted(tuple(r) for r in sample.mapInArrow(sampled, "place long, p double, cells array<long>, amounts array<double>").collect())
    rows = np.repeat(np.arange(len(got)), [len(r[2]) for r in got]).astype(np.int64)
    flat = [np.array([x for r in got for x in r[j]], kind) for j, kind in ((2, np.int64), (3, np.float64))]
    scorer = train_scorer(len(got), rows, *flat, np.array([r[1] for r in got]))
    held = spark.sparkContext.broadcast((labels, scorer))
    new = {"votes": T.StringType(), "weak_label": T.DoubleType(), "score": T.DoubleType(), "good": T.BooleanType()}
    schema = T.StructType([*side.df.schema.fields, *[T.StructField(n, t) for n, t in new.items()]])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, score = held.value
        for batch in batches:
            data, off = pack(batch.column(batch.schema.get_field_index(body)))
            said, weak, marks = [], [], []
            for a, b in chunks(off):
                part, at = data[off[a] : off[b]], off[a : b + 1] - off[a]
                values, words = measures(part, at)
                v = votes(values)
                filled = np.diff(words.first) > 0
                said += ["".join(map(str, row)) for row in v.tolist()]
                weak += np.where(filled, known.posterior(v), 0.0).tolist()
                marks += np.where(filled, score(b - a, *features(part, at, values, words)), 0.0).tolist()
            columns = [pa.array(said, pa.string()), pa.array(weak, pa.float64()), pa.array(marks, pa.float64()), pa.array([m >= 0.5 for m in marks], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *new])

    out = side.df.mapInArrow(judge, schema)
    own = [F.col(c).alias(n) for c, n in zip(side.columns, side.names) if n not in new]
    return out.select(*own, *new)
