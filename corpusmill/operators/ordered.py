"""Order-dependent column work whose groups may be very large.

A window ``partitionBy(g).orderBy(o)`` sorts every row of a group in one task, so one
hot group (a log written by thousands of runs, a conversation with millions of turns)
becomes one huge task. Here the rows are range-partitioned by (group, order): a group
may span many partitions, each of which holds about ``ROWS`` rows, or ``BYTES`` of text,
whatever the groups' sizes, in order. One pass over the sorted rows does what it can inside a
partition, marks its first and last row and the rows of its first group, and names the
partition after its first row. What crosses from one partition to the next is a row or
two for each partition: totals are summed along the partitions that a group spans,
and a first row is handed to the last row before it.

Nothing is written: the rows and the marked rows come from one shuffle, which Spark
uses for both. If it ever made two (``spark.sql.exchange.reuse`` off), their cuts could
differ; a partition then finds no row of its name, and the job fails instead of going
on with the wrong one.

Any orderable column serves as an order column. Rows that tie on all of them are in
the order of a hash of their whole content, so that ties are cut, too; rows that are
equal in every column stay together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = 500_000  # aimed at in a partition
BYTES = 64 << 20  # of text aimed at in a partition
FEW = 4096  # rows below which a further partition is not worth its task

#: of each row: a hash of its content, its partition's name (that of the first row), and
#: whether it is the partition's first or last row or of its first group
TIE, PART, HEAD, TAIL, FIRST = "_tie", "_part", "_head", "_tail", "_first"
MARKS = (TIE, PART, HEAD, TAIL, FIRST)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def range_partitions(df: DataFrame) -> int:
    """As many as the rows and their text need, and as the session asks for where they are few."""
    texts = [F.octet_length(F.col(f"`{f.name.replace('`', '``')}`")) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = reduce(Column.__add__, [F.coalesce(t, F.lit(0)).cast("bigint") for t in texts], F.lit(0).cast("bigint"))
    n, held = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-n // ROWS), -(-held // BYTES), min(asked, n // FEW))


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """For each row but the first, whether it differs from the row before it in any
    of ``columns``; nulls are equal to each other."""
    n = max(0, len(columns[0]) - 1) if columns else 0
    out = np.zeros(n, bool)
    for c in columns:
        a, b = c.slice(1), c.slice(0, n)
        try:
            differ = pc.fill_null(pc.not_equal(a, b), False)
        except pa.ArrowNotImplementedError:  # nested types
            differ = pa.array([x != y for x, y in zip(a.to_pylist(), b.to_pylist())], pa.bool_())
        out |= differ.to_numpy(zero_copy_only=False)
        if c.null_count:
            out |= pc.xor(a.is_null(), b.is_null()).to_numpy(zero_copy_only=False)
    return out


def _in_order(df: DataFrame, group: Sequence[str], order: Sequence[str], new: list[T.StructField], step: Callable, partitions: int | None) -> DataFrame:
    """``df`` range-partitioned and sorted by group and order, with ``MARKS`` and the
    columns that ``step()(batch, after, changed, carried)`` makes of each batch.

    ``after`` is the next row of the partition (or None), ``changed[i]`` says that row
    i + 1 starts a new group, ``carried`` that the batch's first row goes on with the group
    of the batch before; every partition gets a step of its own."""
    clash = {*MARKS, *(f.name for f in new)} & set(df.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    n = partitions or range_partitions(df)
    hashed = df.withColumn(TIE, F.xxhash64(*[F.col(f.name) for f in df.schema.fields if _hashable(f.dataType)]))
    keys = [*group, *order, TIE]
    placed = hashed.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    marks = [T.StructField(PART, T.LongType()), *[T.StructField(name, T.BooleanType()) for name in (HEAD, TAIL, FIRST)]]
    schema = T.StructType([*hashed.schema.fields, *marks, *new])
    names = schema.fieldNames()
    group = list(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = step()
        part = None
        carried, in_first = False, True
        now = None

        def finished(batch: pa.RecordBatch, after: pa.RecordBatch | None) -> pa.RecordBatch:
            nonlocal part, carried, in_first
            n = batch.num_rows
            head, tail, first = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
            if part is None:
                part, head[0] = batch.column(TIE)[0].as_py(), True
            tail[-1] = after is None
            held = [batch.column(g) if after is None else pa.concat_arrays([batch.column(g), after.column(g)]) for g in group]
            changed = _changes(held)
            made = work(batch, after, changed, carried)
            if in_first:
                cut = np.flatnonzero(changed[: n - 1])
                first[: cut[0] + 1 if len(cut) else n] = True
                in_first = not changed.any()
            carried = after is not None and not changed[-1]
            columns = [*batch.columns, pa.array(np.full(n, part, np.int64)), *map(pa.array, (head, tail, first)), *made]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            if batch.num_rows:
                if now is not None:
                    yield finished(now, batch.slice(0, 1))
                now = batch
        if now is not None:
            yield finished(now, None)

    return placed.mapInArrow(run, schema)


def _told(s: DataFrame, edges: DataFrame, told: str) -> DataFrame:
    """``s`` with what ``edges`` (a row for each partition) say of each partition."""
    out = s.join(F.broadcast(edges.select(F.col(PART).alias("_of"), F.struct(told).alias("_told"))), F.col(PART) == F.col("_of"), "left")
    unknown = F.raise_error(F.lit("the rows were cut into partitions twice; spark.sql.exchange.reuse must be on"))
    return out.withColumn(told, F.when(F.col("_told").isNotNull(), F.col("_told")[told]).otherwise(unknown))


class _Sums:
    """Running sums of ``_v`` inside groups."""

    def __init__(self):
        self.total = 0

    def __call__(self, batch, after, changed, carried) -> list[pa.Array]:
        v = batch.column("_v").fill_null(0).to_numpy(zero_copy_only=False)
        start = np.r_[0, np.flatnonzero(changed[: len(v) - 1]) + 1]
        sums = np.cumsum(v)
        base = sums[start] - v[start]
        if carried:
            base[0] -= self.total
        sums = sums - np.repeat(base, np.diff(np.r_[start, len(v)]))
        self.total = sums[-1]
        return [pa.array(sums)]


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, column: str, partitions: int | None = None) -> DataFrame:
    """``column`` = sum of ``value`` (a whole number or a double; null is 0) over the rows
    of the group up to and including this one in ``order``. Unless ``partitions`` is
    given, the rows are counted when this is called."""
    valued = df.withColumn("_v", value)
    whole = isinstance(valued.schema["_v"].dataType, T.IntegralType)
    kind = T.LongType() if whole else T.DoubleType()
    valued = valued.withColumn("_v", F.col("_v").cast(kind))
    s = _in_order(valued, group, order, [T.StructField("_inner", kind)], _Sums, partitions)
    key = F.struct(*[F.col(g) for g in group]).alias("g")
    at = F.struct(*[F.col(o) for o in order], TIE).alias("o")
    zero = F.lit(0).cast(kind)
    asked = s.where(HEAD).select(key, at, PART, F.lit(0).alias("gives"), zero.alias("total"))
    given = s.where(TAIL).select(key, at, PART, F.lit(1).alias("gives"), F.col("_inner").alias("total"))
    before = Window.partitionBy("g").orderBy("o", "gives").rowsBetween(Window.unboundedPreceding, -1)
    offsets = asked.union(given).withColumn("_off", F.coalesce(F.sum("total").over(before), zero)).where("gives = 0")
    out = _told(s, offsets, "_off")
    return out.withColumn(column, F.col("_inner") + F.when(F.col(FIRST), F.col("_off")).otherwise(zero)).select(*df.columns, column)


class _Next:
    """Values of the next row where it is of the same group."""

    def __init__(self, carry: list[str]):
        self.carry = carry

    def __call__(self, batch, after, changed, carried) -> list[pa.Array]:
        n = batch.num_rows
        out = []
        for c in self.carry:
            column = batch.column(c) if after is None else pa.concat_arrays([batch.column(c), after.column(c)])
            at = np.arange(1, n + 1)
            gone = np.ones(n, bool)
            gone[: len(changed)] = changed
            out.append(column.take(pa.array(np.where(gone, 0, at), pa.int64(), mask=gone)))
        return out


def next_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], carry: Sequence[str], prefix: str = "next_", partitions: int | None = None) -> DataFrame:
    """``prefix + c`` = value of ``c`` on the next row of the group in ``order`` (null on
    the group's last row): ``lead`` without a sort of a whole group. A partition's last
    row looks up the next partition's first one. Unless ``partitions`` is given, the rows
    are counted when this is called."""
    carry = list(carry)
    new = [T.StructField(f"_in_{c}", df.schema[c].dataType) for c in carry]
    s = _in_order(df, group, order, new, lambda: _Next(carry), partitions)
    key = F.struct(*[F.col(g) for g in group]).alias("g")
    at = F.struct(*[F.col(o) for o in order], TIE).alias("o")
    value = F.struct(*carry)
    heads = s.where(HEAD).select(key, at, PART, F.lit(0).alias("asks"), value.alias("v"))
    tails = s.where(TAIL).select(key, at, PART, F.lit(1).alias("asks"), value.alias("v"))
    follows = heads.union(tails).withColumn("_after", F.lead("v").over(Window.partitionBy("g").orderBy("o", "asks"))).where("asks = 1")
    out = _told(s, follows, "_after")
    nexts = [F.when(F.col(TAIL), F.col("_after")[c]).otherwise(F.col(f"_in_{c}")).alias(f"{prefix}{c}") for c in carry]
    return out.select(*df.columns, *nexts)
