import hashlib

import pytest

from corpusmill.llm import exact

ROWS = [(1, "a", "x", 1), (2, "a", "y", 2), (2, "a", "y", 2), (3, "", None, 3), (4, None, "z", 4), (None, "a", "n", 5), (5, "A", "x", 6), (6, "b" * 300_000, "x", 7), (7, "b" * 300_000, "x", 8), (None, "q", "x", 9), (None, "q", "x", 9)]
SCHEMA = "doc_id long, text string, kept string, _salt int"


def brute(rows, keep):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r)
    out = []
    for t, rs in groups.items():
        ids = [r[0] for r in rs if r[0] is not None]
        best = (max if keep == "largest" else min)(ids) if ids else None
        taken = False
        for r in rs:
            k = r[0] == best and not taken
            taken = taken or k
            out.append((r[0], r[3], best, len(rs), k, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_against_plain_python(spark, keep, hot_rows):
    out = exact.exact_groups(spark.createDataFrame(ROWS, SCHEMA), keep=keep, hot_rows=hot_rows)
    assert out.columns == ["doc_id", "text", "_salt", "keep_id", "group_size", "kept", "text_sha256"]
    got = sorted(((r.doc_id, r._salt, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out.collect()), key=repr)
    assert got == brute(ROWS, keep)


def test_hot_text_is_spread_and_whole(spark):
    df = spark.range(5000).selectExpr("id doc_id", "if(id % 3 = 0, 'hot', concat('t', id % 2000)) text")
    rows = [(r.doc_id, r.text, None, 0) for r in df.collect()]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(df, hot_rows=100).collect()}
    assert got == {a: (c, d, e) for a, _, c, d, e, _ in brute(rows, "smallest")}


def test_kept_rows_keep_their_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = exact.drop_exact(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 3, 5, 6]
    assert exact.exact_groups(df.limit(0)).count() == 0


def test_normalised_contents(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "A b"), (2, "a  b"), (3, "c")], "doc_id long, text string")
    out = exact.exact_groups(df, normalise=lambda c: F.regexp_replace(F.lower(c), r"\s+", " "))
    assert {r.doc_id: r.kept for r in out.collect()} == {1: True, 2: False, 3: True}


def test_plan_has_no_python_and_one_shuffle_of_the_texts(spark):
    out = exact.exact_groups(spark.createDataFrame(ROWS, SCHEMA))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_plan_with_hot_texts_has_one_shuffle_of_the_texts(spark):
    df = spark.range(100).selectExpr("id doc_id", "if(id < 50, 'hot', string(id)) text")
    plan = exact.exact_groups(df, hot_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1
    assert plan.count("Exchange hashpartitioning") == 1  # the hot texts' facts, one row for each
