"""Explicit eval source, exact seeded rate split, fall-through."""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F

from corpusmill.operators.split import assign_split, eval_count, split_dataset, split_views


def md5_rank_eval(keys, rate, seed=42):
    k = math.ceil(Decimal(str(rate)) * len(keys))
    ranked = sorted(keys, key=lambda x: (hashlib.md5(f"{seed}:{x}".encode()).hexdigest(), x))
    return set(ranked[:k])


@pytest.mark.parametrize(("rate", "n", "k"), [(0.07, 100, 7), (0.1, 1000, 100), (0.5, 3, 2), (0.001, 10, 1)])
def test_eval_count_is_exact_decimal(rate, n, k):
    assert eval_count(rate, n) == k


@pytest.mark.parametrize("rate", [-0.1, 0, 1, 1.5])
def test_rates_outside_open_interval_give_train_only(spark, rate):
    df = spark.range(50).withColumnRenamed("id", "k")
    out = assign_split(df, rate, key="k", unique=True)
    assert rows(out.groupBy("split").count()) == [("train", 50)]


def test_rate_007_on_100_rows(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    out = assign_split(df, 0.07, key="k", unique=True)
    got = {r[0] for r in rows(out.where(F.col("split") == "eval"), "k")}
    assert got == md5_rank_eval(list(range(100)), 0.07)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_split_stable_across_partitioning(spark, parts):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(parts)
    out = assign_split(df, 0.1, key="doc_id", unique=True)
    ev = {r[0] for r in rows(out.where(F.col("split") == "eval"), "doc_id")}
    ids = [r[0] for r in rows(df, "doc_id")]
    assert ev == md5_rank_eval(ids, 0.1)
    assert out.count() == len(ids)


def test_refinement_path_gives_the_same_rows(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    coarse = assign_split(df, 0.3, key="k", unique=True)
    fine = assign_split(df, 0.3, key="k", unique=True, exact_limit=5)
    a = {r[0] for r in rows(coarse.where(F.col("split") == "eval"), "k")}
    b = {r[0] for r in rows(fine.where(F.col("split") == "eval"), "k")}
    assert a == b == md5_rank_eval(list(range(3000)), 0.3)


def test_hot_key_rows_are_not_merged(spark, write):
    # one key value holds a third of the rows; identical rows stay distinct
    import json

    lines = [json.dumps({"g": "hot", "v": 1}) for _ in range(300)] + [json.dumps({"g": f"c{i}", "v": i}) for i in range(600)]
    p = write("hot.jsonl", "\n".join(lines) + "\n")
    from corpusmill.sources.json_corpus import read_json_corpus

    df = read_json_corpus(spark, p)
    out = assign_split(df, 0.25, key="g", exact_limit=10)
    counts = dict(rows(out.groupBy("split").count()))
    assert counts == {"eval": 225, "train": 675}
    again = assign_split(df, 0.25, key="g", exact_limit=100_000)
    assert rows(out.where(F.col("split") == "eval"), "g", "v", order=["g", "v"]) == rows(
        again.where(F.col("split") == "eval"), "g", "v", order=["g", "v"]
    )


def test_same_rows_of_one_frame_however_the_files_are_cut(spark, write):
    import json
    from collections import Counter

    from corpusmill.sources.json_corpus import read_json_corpus

    p = write("cut.jsonl", "".join(json.dumps({"g": "one", "v": i % 1500}) + "\n" for i in range(6000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for rate, key in ((0.1, "g"), (0.1003, "g"), (0.1003, None)):
        out = assign_split(read_json_corpus(spark, p), rate, key=key)
        seen = []
        try:
            for size in (old, "16k", "7k"):
                spark.conf.set("spark.sql.files.maxPartitionBytes", size)
                again = out.select("*")  # planned anew under the setting
                seen.append(Counter(r[0] for r in rows(again.where(F.col("split") == "eval"), "v")))
                assert again.count() == 6000
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert seen[0] == seen[1] == seen[2] and sum(seen[0].values()) == math.ceil(Decimal(str(rate)) * 6000)


def test_a_boundary_among_identical_rows_is_exact(spark):
    df = spark.range(1000).selectExpr("'same' text")
    for limit in (10, 100_000):
        out = assign_split(df, 0.123, exact_limit=limit)
        assert dict(rows(out.groupBy("split").count())) == {"eval": 123, "train": 877}


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_ties_after_a_shuffle_are_exact_each_time_they_are_read(spark, parts):
    """Rows of one content, dealt by a shuffle: whichever are picked, their number holds."""
    df = spark.range(900).selectExpr("if(id < 600, 0, id) v").repartition(parts).sortWithinPartitions(F.rand())
    out = assign_split(df, 0.37, key="v")
    for again in (out, out.repartition(3), out.select("*").where("v >= 0")):
        assert dict(rows(again.groupBy("split").count())) == {"eval": 333, "train": 567}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_a_sketch_that_misses_does_not_change_the_split(spark, monkeypatch):
    from corpusmill.operators import split

    df = spark.range(4000).withColumnRenamed("id", "k").repartition(7)
    want = md5_rank_eval(list(range(4000)), 0.31)
    passes = []
    whole = split._between
    monkeypatch.setattr(split, "_between", lambda keyed, low, high: passes.append((low, high)) or whole(keyed, low, high))
    for slack, sketch in ((0.005, 4096), (-0.1, 4096), (0.0, 8), (2.0, 8)):
        monkeypatch.setattr(split, "SLACK", slack)
        monkeypatch.setattr(split, "SKETCH", sketch)
        out = assign_split(df, 0.31, key="k", unique=True)
        assert {r[0] for r in rows(out.where(F.col("split") == "eval"), "k")} == want
    assert (0, split.TOP) in passes and passes[0] != (0, split.TOP) == passes[-1]


def test_two_passes_whatever_the_size(spark, monkeypatch):
    """The source is read for the sketch and for the bracket; the rest runs on what was written."""
    from corpusmill.operators import split

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    for n, limit in ((500, 10), (20_000, 10)):
        df = spark.range(n).withColumnRenamed("id", "k").mapInArrow(count, "k long")
        before = seen.value
        assign_split(df, 0.2, key="k", unique=True, exact_limit=limit)
        assert seen.value - before == 2 * n


def test_a_label_for_any_table_with_the_key(spark):
    from corpusmill.operators.split import split_label

    keys = spark.range(500).withColumnRenamed("id", "k")
    rows_of = spark.range(2000).selectExpr("id % 500 k", "id v")
    out = rows_of.withColumn("split", split_label(keys, 0.13, key="k"))
    want = md5_rank_eval(list(range(500)), 0.13)
    assert {r[0] for r in rows(out.where("split = 'eval'"), "k")} == want and out.where("split = 'eval'").count() == 4 * len(want)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows(keys.limit(3).withColumn("s", split_label(keys, 0, key="k")), "s") == [("train",)] * 3
    with pytest.raises(ValueError, match="declared unique"):
        split_label(spark.range(100).selectExpr("1 k"), 0.5, key="k")


def test_a_key_that_is_not_unique_raises(spark):
    df = spark.range(1000).selectExpr("1 k", "id")
    with pytest.raises(ValueError, match="declared unique"):
        assign_split(df, 0.1, key="k", unique=True)


def test_eval_source_wins(spark):
    tr = spark.range(10).withColumnRenamed("id", "k")
    ev = spark.createDataFrame([("x",)], "other string")
    out = split_dataset(tr, ev, 0.5, key="k")
    assert dict(rows(out.groupBy("split").count())) == {"train": 10, "eval": 1}
    train, evl = split_views(out)
    assert train.count() == 10 and rows(evl, "k", "other") == [(None, "x")]


def test_split_plan_has_no_global_sort(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = assign_split(df, 0.1, key="doc_id", unique=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and "Exchange" not in plan


def test_keyless_split_does_not_depend_on_file_splits(spark, write):
    import json
    from collections import Counter

    from corpusmill.sources.json_corpus import read_json_corpus

    lines = [json.dumps({"i": i % 2500, "t": "x" * 50}) for i in range(3000)]  # 500 exact duplicates
    p = write("keyless.jsonl", "\n".join(lines) + "\n")

    def eval_rows():
        df = read_json_corpus(spark, p)
        out = assign_split(df, 0.1)
        return Counter(r[0] for r in rows(out.where(F.col("split") == "eval"), "i"))

    default = eval_rows()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        fine = eval_rows()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sum(default.values()) == 300 and default == fine


def test_null_keys_are_ranked_not_dropped(spark, write):
    import json

    from corpusmill.sources.json_corpus import read_json_corpus

    p = write("nullkeys.jsonl", "".join(json.dumps({"k": (None if i % 5 == 0 else i), "v": i}) + "\n" for i in range(200)))
    out = assign_split(read_json_corpus(spark, p), 0.25, key="k")
    assert dict(rows(out.groupBy("split").count())) == {"eval": 50, "train": 150}
