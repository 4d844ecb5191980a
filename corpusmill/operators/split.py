"""Train/eval split: explicit eval source, or an exact seeded rate split.

Rate split contract: ``k = ceil(rate * n)`` rows (``rate`` taken as a decimal
from its string form, so 0.07 of 100 is 7) go to ``eval``: the rows with the
``k`` smallest sort keys, ``md5('<seed>:<key>')`` and after it the md5 of the
row's content (without a key the content alone). A sort key depends on the row's
values only, so the split does not move when Spark cuts the files differently.
Only ``0 < rate < 1`` splits; any other rate gives train only.

Finding the k-th smallest key is a selection in two passes over the rows, not a
sort. The first counts them and keeps a KLL sketch of the keys' first 60 bits (of
fixed size, merged in two levels); its quantiles on either side of the rate bracket
the boundary. The second counts the keys below the bracket and writes down those in
it, about ``2 * SLACK`` of all. What is left runs on that small table: a histogram of
the next 4 hex digits after the prefix its keys share, until a bucket holds at most
``exact_limit`` rows or one key, and a bounded top-k. If the sketch missed (it says
within ``SLACK`` far more than 99 times in 100), the bracket is opened and the second
pass repeated, so the result never depends on it. The labels are then a plain
projection, ``sk <= boundary``: no sort, no window, and a hot key only makes one bucket
bigger, never a task.

Rows with one sort key are identical. If the boundary falls among them, they are
written down once, and as many as are wanted are counted off that table: its
partitions' sizes say in which one the count ends, and the rows' own numbers where.
So the number is exact however the plan is cut, retried or read again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusmill.session import materialize
from corpusmill.sources.json_corpus import META_COLS

HEX_STEP = 4
EXACT_LIMIT = 50_000
SKETCH = 4096  # KLL parameter: ranks to about 0.13 % at 99 % confidence, some 100 KB
SLACK = 0.005  # bracketed on either side of the rate
SALTS = 64  # sketches of the first level
TOP = (1 << 60) - 1


def eval_count(rate: float | str | Decimal, n: int) -> int:
    r = Decimal(str(rate))
    if not (Decimal(0) < r < Decimal(1)):
        return 0
    return int(math.ceil(r * n))


def sort_key(df: DataFrame, key: Sequence[str] | None, seed: int, unique: bool) -> Column:
    """Hex string whose order is the split order: 32 digits of
    ``md5('<seed>:<key>')`` and, unless the key is declared unique, 32 digits of
    the row's content (its raw line when kept, else the JSON of its data columns)."""
    parts = []
    if key:
        # a null key value is hashed as NUL, so such rows are ranked too
        key_str = (
            F.coalesce(F.col(key[0]).cast("string"), F.lit("\u0000"))
            if len(key) == 1
            else F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in key])
        )
        parts.append(F.md5(F.concat(F.lit(f"{seed}:"), key_str)))
    if not key or not unique:
        data = [c for c in df.columns if c not in META_COLS and c != "_raw"]
        content = F.col("_raw") if "_raw" in df.columns else F.to_json(F.struct(*[F.col(c) for c in data]))
        parts.append(F.md5(F.concat(F.lit(f"{seed}:"), content)))
    return F.concat(*parts)


def _histogram(keyed: DataFrame, width: int) -> list[tuple[str, int, str, str]]:
    """(prefix, rows, smallest key, largest key) per ``width``-digit prefix;
    at most 16**4 groups per call, partially aggregated before the shuffle."""
    rows = (
        keyed.groupBy(F.substring("_sk", 1, width).alias("p"))
        .agg(F.count("*").alias("n"), F.min("_sk").alias("lo"), F.max("_sk").alias("hi"))
        .collect()
    )
    return [(r["p"], r["n"], r["lo"], r["hi"]) for r in rows]


def _common_prefix(a: str, b: str) -> str:
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[:i]


def _locate(hist: list, need: int) -> tuple[str, int, int, str, str]:
    """(bucket, rank inside it, bucket size, its smallest and largest key) of
    the ``need``-th row."""
    before = 0
    for bucket, cnt, lo, hi in sorted(hist):
        if before + cnt >= need:
            return bucket, need - before, cnt, lo, hi
        before += cnt
    raise AssertionError("rank beyond the row count")


def assign_split(
    df: DataFrame,
    rate: float | str | Decimal,
    *,
    key: Sequence[str] | str | None = None,
    seed: int = 42,
    unique: bool = False,
    column: str = "split",
    exact_limit: int = EXACT_LIMIT,
    materialize_keys: bool = False,
) -> DataFrame:
    """Label every row ``train`` or ``eval`` (runs small selection jobs; the
    returned DataFrame is lazy).

    ``unique=True`` says that no two rows share a key value, which saves hashing
    the content; if rows at the boundary do share one, this raises.
    ``materialize_keys=True`` writes the sort keys once (about 80 bytes a
    row) under the shared checkpoint folder, so the selection passes read
    that instead of re-running an expensive source (a JSON parse, an
    aggregation) each time."""
    if isinstance(key, str):
        key = [key]
    r = Decimal(str(rate))
    if not (Decimal(0) < r < Decimal(1)):
        return df.withColumn(column, F.lit("train"))
    sk = sort_key(df, key, seed, unique)
    keyed = df.select(sk.alias("_sk"))
    if materialize_keys:
        keyed = materialize(keyed, "split-keys")
    found = _boundary(keyed, r, exact_limit)
    if found is None:
        return df.withColumn(column, F.lit("train"))
    top, wanted, tied = found
    if key and unique and tied > 1:
        raise ValueError(f"key {key} is declared unique, but {tied} rows share the boundary key")
    if wanted == tied:
        return df.withColumn(column, F.when(sk <= F.lit(top), F.lit("eval")).otherwise(F.lit("train")))
    return _count_off(df, sk, top, wanted, column)


def split_label(keys: DataFrame, rate: float | str | Decimal, *, key: Sequence[str] | str, seed: int = 42, exact_limit: int = EXACT_LIMIT) -> Column:
    """The label of ``assign_split`` for a unique key as an expression over the key's
    columns: ``keys`` (a row for each key) is looked at when this is called, and any
    table with those columns is labelled by a projection, without a join."""
    key = [key] if isinstance(key, str) else list(key)
    r = Decimal(str(rate))
    if not (Decimal(0) < r < Decimal(1)):
        return F.lit("train")
    sk = sort_key(keys, key, seed, unique=True)
    found = _boundary(keys.select(sk.alias("_sk")), r, exact_limit)
    if found is None:
        return F.lit("train")
    top, _, tied = found
    if tied > 1:
        raise ValueError(f"key {key} is declared unique, but {tied} rows share the boundary key")
    return F.when(sk <= F.lit(top), F.lit("eval")).otherwise(F.lit("train"))


def _boundary(keyed: DataFrame, rate: Decimal, exact_limit: int) -> tuple[str, int, int] | None:
    """The sort key at the end of the eval rows, how many rows with that key are eval,
    and how many there are; ``None`` if no row is eval."""
    n, low, high = _bracket(keyed, rate)
    k = eval_count(rate, n)
    if k == 0:
        return None
    near, below, size, lo, hi = _between(keyed, low, high)
    if not below < k <= below + size:
        near, below, size, lo, hi = _between(keyed, 0, TOP)
    need = k - below
    bucket = ""
    while size > exact_limit and lo != hi:
        # Every row of the bucket shares the common prefix of its smallest and
        # largest key, so a hot key value is passed in one step, not 4 digits
        # at a time.
        bucket = _common_prefix(lo, hi)
        hist = _histogram(near.where(F.startswith(F.col("_sk"), F.lit(bucket))), len(bucket) + HEX_STEP)
        bucket, need, size, lo, hi = _locate(hist, need)
    if lo == hi:
        return lo, need, size
    inside = near.where(F.startswith(F.col("_sk"), F.lit(bucket)))
    held = inside.groupBy("_sk").agg(F.count("*").alias("n")).collect()  # at most exact_limit
    return _locate([(r["_sk"], r["n"], None, None) for r in held], need)[:3]


def _head(key: Column) -> Column:
    """A sort key's first 60 bits."""
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint")


def _bracket(keyed: DataFrame, rate: Decimal) -> tuple[int, int, int]:
    """The number of rows, and heads between which the key at ``rate`` lies, by the sketch."""
    part = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("part")
    sketches = keyed.groupBy(part).agg(F.count("*").alias("n"), F.kll_sketch_agg_bigint(_head(F.col("_sk")), SKETCH).alias("s"))
    whole = sketches.agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("s", SKETCH).alias("s"))
    low, high = float(rate) - SLACK, float(rate) + SLACK
    at = [F.kll_sketch_get_quantile_bigint("s", F.lit(min(max(q, 0.0), 1.0))) for q in (low, high)]
    n, a, b = whole.select("n", *[F.when(F.col("n") > 0, q) for q in at]).first()
    return n or 0, a if low > 0 else 0, b if high < 1 else TOP


def _between(keyed: DataFrame, low: int, high: int) -> tuple[DataFrame, int, int, str, str]:
    """The keys with heads from ``low`` to ``high``, written down in one pass that also
    tells how many are below, and of these their number, the least and the greatest."""
    seen = Observation()
    inside = F.col("_head").between(low, high)
    held = F.when(inside, F.col("_sk"))
    facts = F.count(F.when(F.col("_head") < low, 1)).alias("below"), F.count(held).alias("n"), F.min(held).alias("lo"), F.max(held).alias("hi")
    head = keyed.withColumn("_head", _head(F.col("_sk"))).observe(seen, *facts)
    near = materialize(head.where(inside).select("_sk"), "split-near")
    told = seen.get
    return near, told["below"], told["n"], told["lo"], told["hi"]


def _count_off(df: DataFrame, sk: Column, top: str, wanted: int, column: str) -> DataFrame:
    """Labels rows by their sort key, exactly ``wanted`` of those at ``top`` as eval. They
    are written once with their numbers: a partition's start where its own begin, and
    count up by one."""
    plain = df.where(sk != top).withColumn(column, F.when(sk < F.lit(top), F.lit("eval")).otherwise(F.lit("train")))
    ties = materialize(df.where(sk == top).withColumn("_number", F.monotonically_increasing_id()), "split-ties")
    sizes = ties.groupBy(F.shiftright("_number", 33).alias("part")).agg(F.min("_number").alias("first"), F.count("*").alias("n"), F.max("_number").alias("last"))
    before, end = 0, 0
    for part in sizes.orderBy("part").collect():  # a row for each written partition
        if part["last"] - part["first"] + 1 != part["n"]:
            raise AssertionError("row numbers of a partition have gaps")
        if before < wanted:
            end = part["first"] + min(part["n"], wanted - before)
        before += part["n"]
    label = F.when(F.col("_number") < end, F.lit("eval")).otherwise(F.lit("train"))
    return plain.unionByName(ties.withColumn(column, label).drop("_number"))


def with_eval_source(train: DataFrame, eval_df: DataFrame, column: str = "split") -> DataFrame:
    """Explicit eval data wins: tag both sides and concatenate by name (read both
    with ``json_corpus.read_train_eval``, so that columns agree in type)."""
    return train.withColumn(column, F.lit("train")).unionByName(
        eval_df.withColumn(column, F.lit("eval")), allowMissingColumns=True
    )


def split_dataset(
    train: DataFrame,
    eval_df: DataFrame | None = None,
    rate: float | str = 0.0,
    **kw,
) -> DataFrame:
    """Eval source when given, else the rate split, else train only."""
    if eval_df is not None:
        return with_eval_source(train, eval_df, kw.get("column", "split"))
    return assign_split(train, rate, **kw)


def split_views(df: DataFrame, column: str = "split") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(column) == "train"), df.where(F.col(column) == "eval")
