"""Exact duplicates by a sort of the contents.

Rows are range-partitioned by Spark's sampled splitters on the first characters
of their (normalised) text and a hash of the whole, and sorted inside each
partition by Spark's external sorter on those and the whole text; equal texts
are then neighbours, and one pass over the sorted rows compares each text with
its neighbour in full. No Python runs.

A text held by a large part of all rows would fill one range. Such texts are
found by counting every row by a 64-bit content hash (partially aggregated);
the threshold is a share of the rows, so at most ``HOT_TEXTS`` texts pass it.
Their rows get a salt as a second range key, which spreads a group over up to
``SALTS`` ranges, and their group facts come from an aggregation that combines
before it shuffles (one row for each hot text). Which texts are salted affects
speed only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.frames import Shielded, text_or_empty

HOT_TEXTS = 1024  # a text is hot when it has more than 1 / HOT_TEXTS of the rows ...
HOT_ROWS = 1000  # ... and more rows than this
SALTS = 256
LEAD = 32  # characters of the text that range keys begin with


def exact_groups(
    df: DataFrame,
    text: str = "text",
    row_id: str = "doc_id",
    normalise: Callable[[Column], Column] | None = None,
    keep: str = "smallest",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``df`` plus ``keep_id`` (the id of the row that stays of this row's group),
    ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text).

    ``keep`` is ``smallest`` or ``largest`` identifier. Null text counts as empty.
    A null id loses to any other. Of rows with equal id and text exactly one is
    kept (they differ at most in other columns). An empty table gives an empty
    result. Columns of ``df`` that have the names of the new ones are replaced.
    The count that finds hot texts runs when this is called; the rest is lazy."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    best = F.min if keep == "smallest" else F.max
    side = Shielded(df)
    rid = side.col(row_id)
    content = text_or_empty(side.col(text))
    rows = side.df.withColumn("_content", normalise(content) if normalise else content)
    # equal texts agree in both; Spark's splitter sample holds these few bytes, not whole texts
    rows = rows.withColumn("_lead", F.substring("_content", 1, LEAD)).withColumn("_hash", F.xxhash64("_content"))
    key = ["_lead", "_hash"]
    hot = _hot_hashes(rows, hot_rows)
    if hot:
        is_hot = F.col("_hash").isin(hot)
        salt = F.pmod(F.xxhash64(F.lit("salt"), F.col(rid)), F.lit(SALTS)).cast("int")
        rows = rows.withColumn("_salt", F.when(is_hot, salt).otherwise(F.lit(0)))
        key = [*key, "_salt"]
    order = F.col(rid).asc_nulls_last() if keep == "smallest" else F.col(rid).desc_nulls_last()
    run = Window.partitionBy(*key, "_content")
    out = rows.repartitionByRange(*key).select(
        *side.columns,
        F.row_number().over(run.orderBy(order)).alias("_at"),
        best(rid).over(run).alias("_keep"),
        F.count(F.lit(1)).over(run).alias("_size"),
        F.sha2("_content", 256).alias("_sha"),
    )
    if hot:
        facts = (
            rows.filter(is_hot)
            .groupBy("_content")
            .agg(best(rid).alias("_hot_keep"), F.count(F.lit(1)).alias("_hot_size"))
            .select(F.sha2("_content", 256).alias("_hot_sha"), "_hot_keep", "_hot_size")
        )  # a row for each hot text: at most HOT_TEXTS
        out = out.join(F.broadcast(facts), F.col("_sha") == F.col("_hot_sha"), "left")
        for own, whole in (("_keep", "_hot_keep"), ("_size", "_hot_size")):
            out = out.withColumn(own, F.when(F.col("_hot_sha").isNotNull(), F.col(whole)).otherwise(F.col(own)))
    kept = (F.col("_at") == 1) & F.col(rid).eqNullSafe(F.col("_keep"))
    new = {"keep_id": F.col("_keep"), "group_size": F.col("_size"), "kept": kept, "text_sha256": F.col("_sha")}
    own = [F.col(c).alias(n) for c, n in zip(side.columns, side.names) if n not in new]
    return out.select(*own, *[c.alias(n) for n, c in new.items()])


def drop_exact(df: DataFrame, text: str = "text", row_id: str = "doc_id", **how) -> DataFrame:
    """The rows of ``df`` that stay, with its columns as they are."""
    side = Shielded(df)
    out = exact_groups(side.df, side.col(text), side.col(row_id), **how).filter("kept")
    return side.restore(out)


def _hot_hashes(rows: DataFrame, hot_rows: int) -> list[int]:
    counted = rows.groupBy(F.col("_hash").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.filter(F.col("n") > hot_rows)
    total = rows.count()
    return [r.h for r in counted.filter(F.col("n") * HOT_TEXTS > total).select("h").collect()]
