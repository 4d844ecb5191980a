"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit set where over half of its word shingles' XXH64
hashes have it. Two fingerprints link when they differ in at most ``DISTANCE`` bits.

Fingerprints are cut into m segments. If two differ in at most d bits, they differ in
at most d // m bits of some segment: each fingerprint is a row of m tables keyed by a
segment's value, and looks up the small Hamming ball around each of its own segments.
Of a ball only the values are looked up whose highest changed bit is set by the change,
so that a pair meets once in a segment, not once from either side. What the tables
give is verified on all 64 bits. With more different fingerprints, fewer and longer
segments with larger balls are cheaper; ``cut`` weighs the two by their number, and
every choice finds the same links.

What that costs at scale:

- equal fingerprints are one row from the start, so copies meet no one;
- in each table, neighbours in the order of all bits are compared first, which joins
  most of a dense group in one pass over the sorted rows; the lookups then only give
  out pairs whose ends are not joined yet, as pairs of groups, combined before they
  are shuffled. A group's pairs are never listed;
- a table value held by over ``HOT`` fingerprints is dealt out: its lookups get a salt
  and its rows a copy for each, so that one task compares no more than ``HOT`` of the
  one with its share of the other.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.components import components
from corpusmill.llm.frames import Shielded
from corpusmill.session import materialize

SHINGLE = 4
SEED = 42
DISTANCE = 4
BITS = 64
HOT = 2048
CHECK = 64  # comparisons that cost as much as one more lookup
STEP = 1 << 16  # hashes whose bits are counted at once
HOT_SHARE = 1000  # a fingerprint of over 1/1000 of all rows is joined by broadcast, at most 1000 of them


def shingle_bits(text: bytes) -> bytes:
    """The fingerprint of a text's UTF-8 bytes, its highest bits first; zero without words."""
    words = text.lower().split()  # bytes: A-Z and the six white space characters only
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    hashed = xxhash.xxh64_digest
    if len(words) <= SHINGLE:
        return hashed(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][: len(words) - SHINGLE + 1].tolist()
    ends = ends[SHINGLE - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(starts), STEP):
        hashes = b"".join([hashed(joined[a:b], SEED) for a, b in zip(starts[k : k + STEP], ends[k : k + STEP])])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(2 * counts > len(starts)).tobytes()


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``fingerprint``, 16 lowercase hex digits; null and empty texts and
    those of white space alone have zero. A column of that name is replaced."""
    side = Shielded(docs)
    body = side.col(text)
    schema = T.StructType([*side.df.schema.fields, T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(body)
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                found = [shingle_bits((t or "").encode("utf-8")).hex() for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "fingerprint"])

    out = side.df.mapInArrow(run, schema)
    own = [out[c].alias(n) for c, n in zip(side.columns, side.names) if n != "fingerprint"]
    return out.select(*own, "fingerprint")


def _widths(m: int) -> list[int]:
    return [BITS // m + (i < BITS % m) for i in range(m)]


def _ball(width: int, radius: int) -> list[int]:
    """Changes of up to ``radius`` bits of a segment, none included."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in itertools.combinations(range(width), r)]


def cut(n: int, distance: int = DISTANCE) -> int:
    """Number of segments: that with the least lookups and comparisons for each of ``n``
    fingerprints, among those with a ball of at least one bit."""

    def cost(m: int) -> float:
        return sum(len(_ball(w, distance // m)) * (1 + n / (CHECK << w)) for w in _widths(m))

    return min(range(2, distance + 1), key=cost) if distance > 1 else 1


def _segments(m: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment."""
    widths = _widths(m)
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _value(shift: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _far(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _table(named: DataFrame, m: int) -> DataFrame:
    """Each fingerprint under its value of every segment; ``rest`` are its bits in an
    order that starts after that segment."""
    out = None
    for i, (shift, width) in enumerate(_segments(m)):
        rest = F.shiftleft("fp", BITS - shift).bitwiseOR(F.shiftrightunsigned("fp", shift)) if shift else F.col("fp")
        part = named.select(F.lit(i).alias("seg"), _value(shift, width).alias("value"), rest.alias("rest"), "fp", "label")
        out = part if out is None else out.union(part)
    return out


def _lookups(named: DataFrame, m: int, distance: int) -> DataFrame:
    out = None
    for i, (shift, width) in enumerate(_segments(m)):
        change = F.explode(F.array(*[F.lit(c).cast("long") for c in _ball(width, distance // m)]))
        part = named.select("fp", "label", _value(shift, width).alias("v"), change.alias("change"))
        # the highest changed bit is set by the change: a value above the fingerprint's own
        part = part.filter("change = 0 OR (v ^ change) > v")
        part = part.select(F.lit(i).alias("seg"), F.col("v").bitwiseXOR(F.col("change")).alias("value"), F.col("fp").alias("other"), F.col("label").alias("other_label"))
        out = part if out is None else out.union(part)
    return out


def _named(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Fingerprints with their group's label (their own where there is no link)."""
    return classes.select("fp").join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))


def link_groups(classes: DataFrame, distance: int = DISTANCE, segments: int | None = None) -> DataFrame:
    """``(fp, label)`` for different fingerprints ``fp`` (longs): the label is the least
    fingerprint that links reach. Runs jobs when it is called; its steps are written to
    the shared checkpoint folder."""
    m = segments or cut(classes.count(), distance)
    alone = classes.select("fp", F.col("fp").alias("label"))
    order = Window.partitionBy("seg", "value").orderBy("rest")
    near = _table(alone, m).withColumn("before", F.lag("fp").over(order))
    near = near.filter(_far("fp", "before") <= distance).select(F.col("before").alias("a"), F.col("fp").alias("b")).distinct()
    named = materialize(_named(classes, components(near)), "simhash-near")
    table, asked = _table(named, m).drop("rest"), _lookups(named, m, distance)
    keys = ["seg", "value"]
    hot = materialize(table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT), "simhash-hot")
    if not hot.isEmpty():
        hot = hot.select(*keys, F.ceil(F.col("n") / HOT).cast("int").alias("ways"))
        ways = F.coalesce("ways", F.lit(1))
        table = table.join(hot, keys, "left").select("seg", "value", "fp", "label", F.explode(F.sequence(F.lit(0), ways - 1)).alias("salt"))
        asked = asked.join(hot, keys, "left").select("seg", "value", "other", "other_label", F.pmod(F.hash("other"), ways).alias("salt"))
        keys.append("salt")
    met = asked.join(table, keys).filter((F.col("label") != F.col("other_label")) & (_far("fp", "other") <= distance))
    met = met.select(F.least("label", "other_label").alias("a"), F.greatest("label", "other_label").alias("b")).distinct()
    joined = components(met).select(F.col("node").alias("label"), F.col("label").alias("least"))
    return named.join(joined, "label", "left").select("fp", F.coalesce("least", "label").alias("label"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE, segments: int | None = None) -> DataFrame:
    """A row for each row of ``docs``: its id, ``fingerprint`` and ``component_id``, the
    smallest id that links of at most ``distance`` differing bits reach.

    Texts without words (null, empty, white space) have fingerprint zero and link like
    any other. Repeated rows give equal rows; rows with a null id get the component's
    smallest id that is not null. An empty table gives an empty result; other columns
    are not looked at. Runs jobs when it is called; its steps are written to the shared
    checkpoint folder."""
    prints = fingerprints(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")))
    # 16 hex digits as a signed long, four bytes at a time
    halves = [F.conv(F.substring("fingerprint", at, 8), 16, 10).cast("long") for at in (1, 9)]
    prints = materialize(prints.select("id", "fingerprint", F.shiftleft(halves[0], 32).bitwiseOR(halves[1]).alias("fp")), "simhash-prints")
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("n")), "simhash-classes")
    groups = materialize(link_groups(classes, distance, segments), "simhash-groups")
    least = groups.join(classes, "fp").groupBy("label").agg(F.min("least_id").alias("component_id"))
    named = materialize(groups.join(least, "label").select("fp", "component_id"), "simhash-named")
    total = classes.agg(F.sum("n")).first()[0] or 0
    many = classes.filter(F.col("n") * HOT_SHARE > total).select("fp")
    hot = named.join(F.broadcast(many), "fp", "left_semi")
    cold = named.join(F.broadcast(many), "fp", "left_anti")
    rest = prints.join(F.broadcast(many), "fp", "left_anti")
    out = prints.join(F.broadcast(hot), "fp").unionByName(rest.join(cold, "fp"))
    return out.select(F.col("id").alias(doc_id), "fingerprint", "component_id")
