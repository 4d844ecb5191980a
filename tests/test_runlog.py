"""L1-L4 and the ordered helpers they use."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusmill.operators.ordered import next_in_group, running_sum
from corpusmill.operators.runlog import number_runs, phase_durations, read_run_logs, run_outcomes

PHASES = ("start", "data_process", "train", "convert_model", "inference")


def events(t0: float, outcome: str) -> list[dict]:
    """Events of one run, following the logging protocol."""
    ev, t = [], t0

    def emit(phase, status, isfin, first=False):
        nonlocal t
        ev.append({"ts": t, "phase": phase, "status": status, "isfin": isfin, "is_total_start": first, "rank": 1})
        t += 1.5

    emit("start", "running", False, first=True)
    for ph in PHASES[1:]:
        emit(ph, "running", False)
        if outcome == "fail" and ph == "train":
            emit(ph, "fail", True)
            return ev
        if outcome == "died" and ph == "convert_model":
            return ev
        emit(ph, "running", True)
    emit("end", "success", True)
    return ev


@pytest.fixture
def log_dir(spark, write, tmp_path):
    a = events(100.0, "success") + events(200.0, "fail") + events(300.0, "died")
    b = events(50.0, "fail")
    write("logs/a.jsonl", "".join(json.dumps(e) + "\n" for e in a))
    write("logs/b.jsonl", "".join(json.dumps(e) + "\n" for e in b))
    return str(tmp_path / "logs")


def test_log_scan_extras_and_runs(spark, log_dir):
    logs = read_run_logs(spark, log_dir)
    assert "rank" in logs.columns
    order = rows(logs.where(F.col("log_id").endswith("a.jsonl")), "seq", "ts", order=["seq"])
    assert [t for _, t in order] == sorted(t for _, t in order)
    runs = number_runs(logs)
    got = rows(runs.groupBy(F.substring_index("log_id", "/", -1).alias("f"), "run_no").count(), order=["f", "run_no"])
    assert got == [("a.jsonl", 1, 10), ("a.jsonl", 2, 5), ("a.jsonl", 3, 6), ("b.jsonl", 1, 5)]
    out = run_outcomes(runs)
    outcomes = rows(out.select(F.substring_index("log_id", "/", -1), "run_no", "outcome"), order=["log_id", "run_no"])
    assert outcomes == [("a.jsonl", 1, "success"), ("a.jsonl", 2, "fail"), ("a.jsonl", 3, "incomplete"), ("b.jsonl", 1, "fail")]


def test_phase_durations_open_and_closed(spark, log_dir):
    d = phase_durations(number_runs(read_run_logs(spark, log_dir)))
    a = d.where(F.col("log_id").endswith("a.jsonl"))
    open_ = rows(a.where(F.col("state") == "open"), "run_no", "phase", order=["run_no", "phase"])
    assert open_ == [(1, "start"), (2, "start"), (3, "convert_model"), (3, "start")]
    closed = rows(a.where(F.col("state") == "closed"), "micros")
    assert closed and all(m == (1_500_000,) for m in closed)


def test_ordered_helpers_equal_windows_with_a_hot_group(spark):
    n = 4000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),  # group 0 holds ~1/3
        (F.hash("id") % 1000).alias("o"),
        F.col("id").alias("tb"),
        (F.col("id") % 7 == 0).cast("bigint").alias("v"),
    )
    w = Window.partitionBy("g").orderBy("o", "tb")
    want = df.select(
        "tb",
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
        F.lead("v").over(w).alias("nv"),
        F.lead("o").over(w).alias("no"),
    )
    got_rs = running_sum(df, ["g"], ["o", "tb"], F.col("v"), "rs", partitions=16).select("tb", "rs")
    got_nx = next_in_group(df, ["g"], ["o", "tb"], ["v", "o"], partitions=16).select("tb", "next_v", "next_o")
    joined = want.join(got_rs, "tb").join(got_nx, "tb")
    bad = joined.where(
        (want["rs"] != got_rs["rs"])
        | ~F.col("nv").eqNullSafe(F.col("next_v"))
        | ~F.col("no").eqNullSafe(F.col("next_o"))
    )
    assert joined.count() == n and bad.count() == 0


def cut(df, group, order, partitions):
    from pyspark.sql import types as T

    from corpusmill.operators.ordered import _in_order, _Next

    s = _in_order(df, group, order, [T.StructField("_in_o", df.schema["o"].dataType)], lambda: _Next(["o"]), partitions)
    return s.groupBy("_part").agg(F.count("*").alias("n"), F.min("o").alias("a"), F.max("o").alias("b"))


def test_hot_group_is_cut_into_several_partitions(spark):
    df = spark.range(3000).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    sizes = rows(cut(df, ["g"], ["o"], 8), "n", "a", "b", order=["a"])
    assert len(sizes) == 8 and max(n for n, _, _ in sizes) < 700
    assert all(x[2] < y[1] for x, y in zip(sizes, sizes[1:]))
    many = rows(cut(df, ["g"], ["o"], 300), "n", "a", "b")
    assert len(many) > 250 and max(b - a for _, a, b in many) <= 30


def test_partitions_follow_the_rows(spark, monkeypatch):
    """Ten times the rows make ten times the partitions, not longer tasks."""
    from corpusmill.operators import ordered

    monkeypatch.setattr(ordered, "ROWS", 500)
    longest = []
    for n in (3000, 30_000):
        df = spark.range(n).select(F.lit("a").alias("g"), F.col("id").alias("o"))
        sizes = rows(cut(df, ["g"], ["o"], None), "n")
        assert len(sizes) >= 0.9 * n / 500
        longest.append(max(s for s, in sizes))
    assert longest[1] <= 1500 and longest[0] <= 1500


def test_string_order_and_ties_are_cut(spark):
    df = spark.range(3000).select(F.lit("a").alias("g"), F.format_string("%05d", F.col("id")).alias("o"), F.lit(1).alias("v"))
    assert len(rows(cut(df, ["g"], ["o"], 10), "n")) == 10
    got = running_sum(df, ["g"], ["o"], F.col("v"), "n", partitions=10)
    assert got.where(F.col("n") != F.col("o").cast("int") + 1).count() == 0
    tied = spark.range(3000).select(F.lit("a").alias("g"), F.lit(1.5).alias("o"), "id")  # one time, no tiebreak
    sizes = rows(cut(tied, ["g"], ["o"], 10), "n")
    assert len(sizes) == 10 and max(n for n, in sizes) < 700
    numbered = running_sum(tied, ["g"], ["o"], F.lit(1), "n", partitions=10)
    assert rows(numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n"))) == [(1, 3000, 3000)]
    same = spark.range(500).select(F.lit("a").alias("g"), F.lit(1).alias("o"))
    assert rows(running_sum(same, ["g"], ["o"], F.lit(1), "n", partitions=4).agg(F.min("n"), F.max("n"), F.count_distinct("n"))) == [(1, 500, 500)]


def test_groups_that_end_at_a_cut_and_groups_over_many(spark):
    """Sums and next rows across every kind of border, batches included."""
    data = [(g, o, (g * 7 + o) % 5) for g, n in enumerate([1, 1, 400, 1, 2, 37, 300, 1, 1, 90]) for o in range(n)]
    df = spark.createDataFrame(data, "g int, o int, v int")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, total = {}, {}
    for g, o, v in data:
        total[g] = total.get(g, 0) + v
        want[g, o] = total[g]
    try:
        for batch in ("10000", "7", "1"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            for parts in (1, 13, 200):
                rs = running_sum(df, ["g"], ["o"], F.col("v"), "s", partitions=parts)
                assert {(g, o): s for g, o, s in rows(rs, "g", "o", "s")} == want
                nx = next_in_group(df, ["g"], ["o"], ["o", "v"], partitions=parts)
                assert all(n == (o + 1 if (g, o + 1) in want else None) for g, o, n in rows(nx, "g", "o", "next_o"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_one_shuffle_serves_rows_and_borders(spark):
    """Without the reuse of a shuffle the rows may be cut twice: the job fails, or both cuts agree."""
    df = spark.range(3000).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    out = running_sum(df, ["g"], ["o"], F.lit(1), "n", partitions=8)
    assert sorted(r.n for r in out.collect()) == list(range(1, 3001))
    plan = out._jdf.queryExecution().executedPlan().toString().lower()
    assert "reusedexchange" in plan and "rangepartitioning" in plan
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = sorted(r.n for r in out.select("*").collect())
        assert got == list(range(1, 3001))
    except PySparkException as e:
        assert "exchange.reuse" in str(e)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_phase_durations_write_nothing(spark, log_dir):
    import os

    from corpusmill.session import checkpoint_root

    before = set(os.listdir(f"{checkpoint_root(spark)}/corpusmill")) if os.path.isdir(f"{checkpoint_root(spark)}/corpusmill") else set()
    phase_durations(number_runs(read_run_logs(spark, log_dir))).count()
    root = f"{checkpoint_root(spark)}/corpusmill"
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before


def test_phase_duration_of_wall_clock_times_ignores_session_zone(spark):
    import datetime

    df = spark.createDataFrame(
        [(1, 1, "train", datetime.datetime(2024, 3, 10, 1, 30), False, 1), (1, 1, "train", datetime.datetime(2024, 3, 10, 3, 30), True, 2)],
        "log_id int, run_no int, phase string, ts timestamp_ntz, isfin boolean, event_id int",
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")  # DST starts at 02:00 that night
    try:
        got = rows(phase_durations(df, tiebreak=("event_id",)), "micros")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [(2 * 3600 * 1_000_000,)]


def test_null_group_keys_keep_their_rows(spark):
    df = spark.createDataFrame(
        [(None, 1, 0.0, None, False), (None, 2, 1.0, None, True), ("a", 3, 0.0, None, False), ("a", 4, 2.0, "p", False)],
        "g string, seq int, ts double, phase string, isfin boolean",
    )
    rs = running_sum(df, ["g"], ["ts", "seq"], F.lit(1), "n", partitions=3)
    assert rows(rs, "seq", "n", order=["seq"]) == [(1, 1), (2, 2), (3, 1), (4, 2)]
    nx = next_in_group(df, ["g", "phase"], ["ts", "seq"], ["isfin"], partitions=3)
    assert rows(nx, "seq", "next_isfin", order=["seq"]) == [(1, True), (2, None), (3, None), (4, None)]


def test_rows_of_one_time_are_cut_by_their_tiebreak(spark):
    df = spark.range(3000).select(
        F.lit("a").alias("g"),
        F.when(F.col("id") < 2400, 7.5).otherwise(F.col("id").cast("double")).alias("o"),
        F.struct(F.lit(0).alias("block"), F.col("id").alias("row")).alias("seq"),
        F.lit(1).alias("v"),
    )
    sizes = rows(cut(df, ["g"], ["o", "seq"], 10), "n")
    assert len(sizes) >= 9 and max(n for n, in sizes) <= 700
    got = running_sum(df, ["g"], ["o", "seq"], F.col("v"), "n", partitions=10)
    assert got.where(F.col("n") != F.col("seq.row") + 1).count() == 0
    following = next_in_group(df, ["g"], ["o", "seq"], ["seq"], partitions=10)
    assert following.where(F.col("next_seq.row") != F.col("seq.row") + 1).count() == 0
    assert following.where(F.col("next_seq").isNull()).count() == 1


def test_a_log_of_the_fixture_has_a_file_or_a_few(spark, tmp_path):
    from collections import Counter

    from corpusmill.plans.catalog import _log_fixture
    from corpusmill.sources.files import list_files_recursive

    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    events.union(events.where("user_id = 7").crossJoin(spark.range(400)).withColumn("event_id", F.col("id") + 100_000).drop("id")).write.parquet(f"{tmp_path}/events.parquet")
    files = list_files_recursive(spark, _log_fixture(spark, str(tmp_path)))
    held = Counter(f.path.rsplit("/", 2)[1] for f in files)
    logs = events.select("user_id").distinct().count()
    assert len(held) == logs
    assert len(files) < 2 * logs  # was one for each of eight parts of a log
    assert max(held.values()) == held["log_id=7"] > 1  # the long log does not fill one task


def test_logs_are_written_without_a_process_for_each(spark, tmp_path):
    """The tasks write local files themselves: none of Hadoop's checksum files, for each of
    which it starts a process, nothing unfinished, and the rows that Spark's writer gives."""
    import os

    from corpusmill.plans import fixtures as fx

    df = spark.range(3000).select(
        F.when(F.col("id") % 50 > 0, F.col("id") % 50 - 2).alias("log_id"),
        F.col("id").alias("event_id"),
        (F.col("id") / 3).alias("ts"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit('ü"\n\u2028'), F.col("id").cast("string"))).alias("phase"),
        (F.col("id") % 2 == 1).alias("isfin"),
    )
    df = df.union(df.where("log_id = 7").crossJoin(spark.range(400)).select("log_id", F.col("id") + 10_000, "ts", "phase", "isfin"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.logs.link./in", f"file://{tmp_path}")
    by_spark, by_tasks = "viewfs://logs/in/spark", str(tmp_path / "tasks")
    for root in (by_spark, by_tasks):
        fx.write_by_key(df, "log_id", "event_id", root, 8)
    left = [f for _, _, files in os.walk(by_tasks) for f in files]
    assert left and all(f.startswith("part-") and f.endswith(".json") for f in left)
    assert {d for d in os.listdir(by_tasks)} == {d for d in os.listdir(tmp_path / "spark") if "=" in d}
    assert len(os.listdir(f"{by_tasks}/log_id=7")) > 1
    a, b = (rows(spark.read.json(root), "log_id", "event_id", "ts", "phase", "isfin") for root in (by_spark, by_tasks))
    assert len(a) == df.count() and sorted(a, key=repr) == sorted(b, key=repr)
    held = [e for d in sorted(os.listdir(f"{by_tasks}/log_id=7")) for e in map(json.loads, open(f"{by_tasks}/log_id=7/{d}", encoding="utf-8"))]
    assert [e["event_id"] for e in held] == sorted(e["event_id"] for e in held)
