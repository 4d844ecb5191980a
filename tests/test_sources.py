"""Path specs, JSON layouts, whole text files, routing."""

from __future__ import annotations

import json
import os

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusmill.sources import files as files_mod
from corpusmill.sources import json_corpus as corpus_mod
from corpusmill.sources.corpus import read_pretrain_corpus
from corpusmill.sources.json_corpus import read_json_corpus, read_json_files, read_prompt_file
from corpusmill.sources.paths import (
    expand_spec,
    join_spec,
    offline_file_list,
    require_files,
    route_by_suffix,
    split_spec,
)
from corpusmill.sources.text_corpus import read_text_files


def jl(*objs) -> str:
    return "".join(json.dumps(o, ensure_ascii=False) + "\n" for o in objs)


def names(exp):
    return [f.name for f in exp.files]


# ------------------------------------------------------------------ S1 / S2


def test_split_spec_separators_trim_and_empty_parts():
    assert split_spec(" a.jsonl ; ,b.jsonl,, c.json ;") == ["a.jsonl", "b.jsonl", "c.json"]


def test_list_spec_items_are_split_again():
    assert join_spec(["a.jsonl", "b.jsonl,c.jsonl"]) == "a.jsonl;b.jsonl,c.jsonl"
    assert split_spec(["a.jsonl", "b.jsonl,c.jsonl"]) == ["a.jsonl", "b.jsonl", "c.jsonl"]


def test_directory_expands_sorted_jsonl_then_json_no_txt_no_recursion(spark, write, tmp_path):
    d = tmp_path / "mixed"
    write("mixed/b.jsonl", jl({"text": "b"}))
    write("mixed/a.jsonl", jl({"text": "a"}))
    write("mixed/c.json", jl({"text": "c"}))
    write("mixed/d.txt", "d")
    write("mixed/sub/e.jsonl", jl({"text": "e"}))
    exp = expand_spec(spark, str(d))
    assert names(exp) == ["a.jsonl", "b.jsonl", "c.json"]
    df = read_json_corpus(spark, str(d))
    assert rows(df, "text", order=["_file_ord", "_block_ord", "_row_ord"]) == [("a",), ("b",), ("c",)]


def test_spec_blanks_missing_and_duplicates_kept_in_order(spark, write, tmp_path):
    a = write("a.jsonl", jl({"x": 1}, {"x": 2}))
    b = write("b.jsonl", jl({"x": 3}))
    spec = f" {a} ; ,{tmp_path}/missing.jsonl,{b},{a}"
    exp = expand_spec(spark, spec)
    assert names(exp) == ["a.jsonl", "b.jsonl", "a.jsonl"]
    assert exp.missing == [f"{tmp_path}/missing.jsonl"]
    df = read_json_corpus(spark, spec)
    got = rows(df, "x", "_file_ord", order=["_file_ord", "_block_ord", "_row_ord"])
    assert got == [(1, 0), (2, 0), (3, 1), (1, 2), (2, 2)]


def test_file_kept_whatever_its_suffix(spark, write):
    p = write("data.dat", jl({"x": 1}))
    assert names(expand_spec(spark, p)) == ["data.dat"]


def test_hidden_file_named_explicitly_raises(spark, write):
    p = write("_hidden.jsonl", jl({"x": 1}))
    with pytest.raises(ValueError, match="skipped by Spark"):
        expand_spec(spark, p)


def test_glob_characters_in_names_are_literal(spark, write):
    p = write("x[1].jsonl", jl({"x": 7}))
    assert rows(read_json_corpus(spark, p), "x") == [(7,)]


def test_literal_list_keeps_commas(spark, write):
    p = write("a,b.jsonl", jl({"x": 5}))
    exp = expand_spec(spark, [p], literal=True)
    assert names(exp) == ["a,b.jsonl"]


# ------------------------------------------------------------------ S3 / S4 / S9


def test_blank_lines_skipped(spark, write):
    p = write("blanks.jsonl", '{"x": 1}\n\n   \n{"x": 2}\n\t\n')
    assert rows(read_json_corpus(spark, p), "x", order=["_row_ord"]) == [(1,), (2,)]


def test_malformed_line_raises(spark, write):
    p = write("bad.jsonl", '{"x": 1}\n{"x": \n{"x": 3}\n')
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_json_corpus(spark, p).collect()  # inference or the scan fails


def test_json_array_file_and_lines_under_json_name(spark, write):
    a = write("array.json", json.dumps([{"x": 1}, {"x": 2}, {"x": 3}], indent=2))
    b = write("lines.json", jl({"x": 4}, {"x": 5}))
    df = read_json_corpus(spark, f"{a};{b}")
    got = rows(df, "x", order=["_file_ord", "_block_ord", "_row_ord"])
    assert got == [(1,), (2,), (3,), (4,), (5,)]


def test_superset_schema_and_widening(spark, write):
    a = write("a.jsonl", jl({"x": 1, "y": "s"}))
    b = write("b.jsonl", jl({"x": "two", "z": True}))
    df = read_json_corpus(spark, f"{a};{b}")
    assert dict(df.dtypes)["x"] == "string"
    got = rows(df, "x", "y", "z", order=["_file_ord"])
    assert got == [("1", "s", None), ("two", None, True)]


def test_messages_infer_as_array_of_structs(spark, write):
    p = write("m.jsonl", jl({"messages": [{"role": "user", "content": "hi"}]}, {"messages": None}, {"messages": []}))
    df = read_json_corpus(spark, p)
    assert dict(df.dtypes)["messages"] == "array<struct<content:string,role:string>>"


def test_prompt_file_lossless_keeps_raw_line(spark, write):
    p = write("p.jsonl", '{"b": 1, "a": null}\n\n{"a": "x"}\n')
    df = read_prompt_file(spark, p, lossless=True)
    assert rows(df, "_raw", order=["_row_ord"]) == [('{"b": 1, "a": null}',), ('{"a": "x"}',)]
    tabs = write("tabs.jsonl", '{"a": ""}\n\t\n \t {"a": "x"}\t\r\n\r\n')
    assert rows(read_prompt_file(spark, tabs, lossless=True), "_raw", "a", order=["_row_ord"]) == [('{"a": ""}', ""), ('{"a": "x"}', "x")]


def test_prompt_file_missing_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_prompt_file(spark, str(tmp_path / "nope.jsonl"))


# ------------------------------------------------------------------ S6 / S7 / U1


def test_whole_text_drops_bad_bytes_and_translates_newlines(spark, write):
    p = write("badbytes.txt", b"h\xff\xfei\r\nx\xe2\x82")
    exp = expand_spec(spark, [p], literal=True)
    assert rows(read_text_files(spark, exp.files), "text") == [("hi\nx",)]


def test_a_text_file_too_long_for_a_row_is_refused_by_name(spark, write):
    from dataclasses import replace

    exp = expand_spec(spark, [write("big.txt", "x")], literal=True)
    with pytest.raises(ValueError, match=r"big.txt: 2147483648 bytes"):
        read_text_files(spark, [replace(f, length=1 << 31) for f in exp.files])


def test_whole_text_one_row_per_file(spark, write):
    p = write("two_lines.txt", "line one\nline two\n")
    exp = expand_spec(spark, [p], literal=True)
    assert rows(read_text_files(spark, exp.files), "text") == [("line one\nline two\n",)]


def test_route_by_suffix_case_insensitive(spark, write):
    a = write("UPPER.TXT", "t")
    b = write("x.csv", "c")
    c = write("y.JSONL", jl({"text": "j"}))
    js, tx, other = route_by_suffix(expand_spec(spark, f"{a};{b};{c}").files)
    assert [f.name for f in js] == ["y.JSONL"]
    assert [f.name for f in tx] == ["UPPER.TXT"]
    assert [f.name for f in other] == ["x.csv"]


def test_pretrain_corpus_json_then_text_chunks(spark, write):
    t = write("doc.txt", "from text")
    j = write("doc.jsonl", jl({"text": "from json", "doc_id": 1}))
    df, held_out = read_pretrain_corpus(spark, f"{t};{j}")
    assert held_out is None
    got = rows(df, "text", "doc_id", order=["_file_ord"])
    assert got == [("from json", 1), ("from text", None)]


def test_pretrain_only_unusable_suffixes_raises(spark, write):
    p = write("x.csv", "c")
    with pytest.raises(ValueError, match="none of the files"):
        read_pretrain_corpus(spark, p)


def test_pretrain_requires_text_column(spark, write):
    p = write("notext.jsonl", jl({"body": "x"}))
    with pytest.raises(ValueError, match="text"):
        read_pretrain_corpus(spark, p)


def test_explicit_txt_in_json_loader_raises(spark, write):
    p = write("a.txt", "x")
    with pytest.raises(ValueError, match="not JSON"):
        read_json_corpus(spark, p)


# ------------------------------------------------------------------ S5 mixture


def test_mixture_row_order_and_duplicates(spark, write):
    a = write("s/a.jsonl", jl(*[{"i": i} for i in range(5)]))
    b = write("s/b.jsonl", jl(*[{"i": 10 + i} for i in range(3)]))
    df = read_json_corpus(spark, [b, a, b], literal=True)
    got = [r[0] for r in rows(df, "i", order=["_file_ord", "_block_ord", "_row_ord"])]
    assert got == [10, 11, 12, 0, 1, 2, 3, 4, 10, 11, 12]
    assert rows(df.groupBy("_spec_ord").count(), order=["_spec_ord"]) == [(0, 3), (1, 5), (2, 3)]


# ------------------------------------------------------------------ S8 / V1 / V2 / V3


def test_offline_file_list_is_literal(spark, write, tmp_path):
    a = write("o/a.jsonl", jl({"x": 1}))
    assert names(offline_file_list(spark, f"{a};")) == ["a.jsonl"]
    with pytest.raises(FileNotFoundError):
        offline_file_list(spark, f"{a},{tmp_path}/missing.jsonl")
    with pytest.raises(ValueError, match="directory"):
        offline_file_list(spark, str(tmp_path / "o"))


def test_empty_expansion_raises_naming_spec(spark, tmp_path):
    spec = f"{tmp_path}/none.jsonl"
    with pytest.raises(FileNotFoundError, match="none.jsonl"):
        require_files(expand_spec(spark, spec))
    with pytest.raises(FileNotFoundError):
        read_json_corpus(spark, spec)


def test_directory_of_text_files_is_no_files(spark, write, tmp_path):
    write("t/a.txt", "x")
    with pytest.raises(FileNotFoundError):
        read_pretrain_corpus(spark, str(tmp_path / "t"))


def test_read_json_files_same_path_twice_reads_twice(spark, write):
    a = write("twice.jsonl", jl({"x": 1}))
    exp = expand_spec(spark, f"{a};{a}")
    df = read_json_files(spark, exp.files)
    assert rows(df, "x", "_file_ord", order=["_file_ord"]) == [(1, 0), (1, 1)]


def test_scan_prunes_columns(spark, write):
    a = write("wide.jsonl", jl({"x": 1, "y": "a", "z": 2.5}))
    df = read_json_corpus(spark, a).select("x").where(F.col("x") > 0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:bigint>" in plan  # no "" was met: parsed as what it is
    df = read_json_corpus(spark, a, schema="x bigint, y string, z double").select("x").where(F.col("x") > 0)
    assert "ReadSchema: struct<x:bigint>" in df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_for_a_path_listed_three_times(spark, write):
    a = write("thrice.jsonl", jl({"x": 1}))
    df = read_json_corpus(spark, f"{a};{a};{a}")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1
    assert rows(df, "x", "_file_ord", order=["_file_ord"]) == [(1, 0), (1, 1), (1, 2)]


def test_file_that_the_list_does_not_name_raises(spark, write):
    from dataclasses import replace

    exp = expand_spec(spark, write("odd.jsonl", jl({"x": 1})))
    moved = [replace(f, uri=f.uri + "?") for f in exp.files]
    with pytest.raises(Exception, match="not in the expanded spec"):
        read_json_files(spark, moved, schema="x bigint").collect()


def test_chats_survive_null_empty_and_blank_messages_elsewhere(spark, write):
    chat = [{"role": "user", "content": "hi"}]
    a = write("c/chat.jsonl", jl({"messages": chat, "n": 1}, {"messages": "", "n": ""}, {"messages": []}))
    b = write("c/null.json", json.dumps([{"messages": None, "n": 2}, {"messages": None, "n": None}]))
    c = write("c/empty.jsonl", jl({"messages": []}))
    df = read_json_corpus(spark, f"{b};{a};{c}")
    assert dict(df.dtypes)["messages"] == "array<struct<content:string,role:string>>"
    got = [(None if m is None else len(m), n) for m, n in rows(df, "messages", "n", order=["_file_ord", "_block_ord", "_row_ord"])]
    assert got == [(None, 2), (None, None), (1, 1), (None, None), (0, None), (0, None)]
    from corpusmill.functions.schema import has_messages

    assert df.where(has_messages(df)).count() == 1


def test_list_against_text_raises_naming_the_column(spark, write):
    a = write("k/a.jsonl", jl({"messages": [{"role": "user", "content": "hi"}]}))
    b = write("k/b.json", json.dumps([{"messages": "some text"}]))
    with pytest.raises(ValueError, match="messages"):
        read_json_corpus(spark, f"{a};{b}")


def test_text_in_a_messages_column_fails_its_row(spark, write):
    from corpusmill.functions.prompts import render

    df = read_json_corpus(spark, write("t.jsonl", jl({"instruction": "q", "messages": "hello"})))
    with pytest.raises(Exception, match="not a list of messages"):
        render(df, "chatml", "train", keep=()).collect()


def test_field_seen_in_one_late_row_only(spark, write):
    p = write("late.jsonl", jl(*[{"x": i} for i in range(5000)], {"x": 1, "rare": "r"}))
    assert read_json_corpus(spark, p).where("rare = 'r'").count() == 1


def test_layout_behind_a_megabyte_of_blanks(spark, write):
    p = write("blank.json", " \n" * (600 << 10) + json.dumps([{"x": 1}, {"x": 2}]))
    assert rows(read_json_corpus(spark, p), "x", order=["x"]) == [(1,), (2,)]


def test_named_files_are_found_many_at_a_time(spark, write, tmp_path, monkeypatch):
    """Existing, missing, empty and hidden names, folders of every kind, odd steps, relative paths."""
    from corpusmill.sources import files

    names = [f"f{i:02d}.jsonl" for i in range(12)] + ["a b.jsonl", "x[1].jsonl", "ü.json", "c,d.json", "{e}.json", "p%20q.jsonl"]
    for n in names:
        write(f"many/{n}", "{}\n")
    for n in ("many/empty.json", "other/void.txt"):
        write(n, "")
    write("many/sub/in.jsonl", "{}\n")
    write("many/sub/deep/er.jsonl", "{}\n")
    write("many/texts/t.txt", "x")
    write("many/texts/k=1/t.txt", "x")
    write("other/lone.jsonl", "{}\n")
    (tmp_path / "many" / "bare").mkdir()
    d = str(tmp_path / "many")
    parts = [f"{d}/{n}" for n in reversed(names)] + [
        f"{d}/missing.jsonl", f"{d}/sub", f"{d}/sub/", f"{d}/f03.jsonl", f"{d}/./f01.jsonl", f"{d}/../other/lone.jsonl",
        str(tmp_path / "other/lone.jsonl"), f"{d}/empty.json", f"{d}/bare", f"{d}/texts", f"{tmp_path}/none/at.json", f"file://{d}/f02.jsonl",
        os.path.relpath(f"{d}/f04.jsonl"), os.path.relpath(f"{d}/sub"), str(tmp_path / "other/void.txt"),
    ]
    for size in (32, 3):
        monkeypatch.setattr(files, "NAMES", size)
        found = files.look_up(spark, parts, (".jsonl", ".json"))
        for part, f in zip(parts, found):
            local = part.removeprefix("file://")
            if not os.path.exists(local):
                assert f is None, part
                continue
            assert f.is_dir == os.path.isdir(local), part
            if f.is_dir:
                want = sorted(n for n in os.listdir(local) if n.endswith((".json", ".jsonl")) and os.path.isfile(f"{local}/{n}"))
                assert [c.name for c in f.children] == want, part
            else:
                assert f.name == os.path.basename(local) and f.length == os.path.getsize(local)
                assert os.path.samefile(f.path.removeprefix("file:"), local)


def test_a_large_folder_is_listed_without_a_loop_over_the_driver(spark, tmp_path):
    """20,000 names: one job and one transfer; nothing is asked for by name."""
    import time

    d = tmp_path / "large"
    d.mkdir()
    for i in range(20_000):
        (d / f"{i:05d}.jsonl").write_bytes(b"{}\n")
    from py4j.java_gateway import GatewayClient

    calls = []
    whole = GatewayClient.send_command
    GatewayClient.send_command = lambda self, *a, **k: calls.append(1) or whole(self, *a, **k)
    try:
        t = time.time()
        exp = expand_spec(spark, str(d))
        took = time.time() - t
    finally:
        GatewayClient.send_command = whole
    assert names(exp) == [f"{i:05d}.jsonl" for i in range(20_000)]
    assert len(calls) < 1000 and took < 120


def test_sources_hold_no_java_objects():
    import corpusmill.sources as package

    folder = os.path.dirname(package.__file__)
    for name in os.listdir(folder):
        if name.endswith(".py"):
            with open(os.path.join(folder, name)) as f:
                text = f.read()
            assert not any(x in text for x in ("_jvm", "_jsc", "_jdf", "py4j", "sparkContext")), name


def test_a_colon_in_a_name_beside(spark, write, tmp_path):
    """No pattern works in such a folder: its files are still found."""
    write("col/a.jsonl", jl({"x": 1}))
    write("col/b:c.txt", "x")
    write("top/col2/a.jsonl", jl({"x": 2}))
    write("top/d:e", "x")
    assert names(expand_spec(spark, f"{tmp_path}/col;{tmp_path}/col/a.jsonl;{tmp_path}/top/col2;{tmp_path}/top/nope")) == ["a.jsonl"] * 3


def test_valid_text_is_decoded_without_python(spark, write):
    exp = expand_spec(spark, [write("v.txt", "ünï\r\nx"), write("w.txt", b"a\xffb")], literal=True)
    assert rows(read_text_files(spark, exp.files), "text", order=["_file_ord"]) == [("ünï\nx",), ("ab",)]


def test_names_of_every_kind_in_a_folder(spark, write, tmp_path):
    listed = ["a b.jsonl", "x[1].jsonl", "p%20q.jsonl", "ü.json", "e f.json", "emoji🙂.jsonl", "semi;c,p+e=.jsonl",
              "hash#q.jsonl", "q'uote(1).jsonl", "tab\tx.jsonl", "plain.jsonl", "_h.jsonl", "sub.jsonl/in.jsonl", "k=1/in.jsonl"]
    for n in listed:
        write(f"t/{n}", "{}\n")
    d = str(tmp_path / "t")
    exp = expand_spec(spark, d)
    plain = [n for n in listed if "/" not in n and not n.startswith("_")]
    assert names(exp) == sorted(n for n in plain if n.endswith(".jsonl")) + sorted(n for n in plain if n.endswith(".json"))
    df = read_json_corpus(spark, d)  # every listed file is read and joined to its position
    assert df.count() == 11 and df.select("_file_ord").distinct().count() == 11


def test_row_order_survives_many_splits_per_file(spark, write):
    a = write("big/a.jsonl", jl(*[{"i": i, "pad": "x" * 40} for i in range(5000)]))
    b = write("big/b.jsonl", jl(*[{"i": 10_000 + i, "pad": "y" * 40} for i in range(3000)]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_json_corpus(spark, f"{b};{a}")
        assert df.select("_block_ord").distinct().count() > 10  # really split
        got = [r[0] for r in rows(df, "i", order=["_file_ord", "_block_ord", "_row_ord"])]
        lossless = read_prompt_file(spark, a, lossless=True)
        got_lossless = [r[0] for r in rows(lossless, "i", order=["_file_ord", "_block_ord", "_row_ord"])]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(range(10_000, 13_000)) + list(range(5000))
    assert got_lossless == list(range(5000))


def test_empty_text_file_is_one_empty_row(spark, write):
    a = write("e/empty.txt", b"")
    b = write("e/full.txt", "x")
    exp = expand_spec(spark, [a, b, a], literal=True)
    assert rows(read_text_files(spark, exp.files), "_file_ord", "text", order=["_file_ord"]) == [(0, ""), (1, "x"), (2, "")]
    df, _ = read_pretrain_corpus(spark, f"{a};{b}")
    assert rows(df, "text", order=["_file_ord"]) == [("",), ("x",)]


# ------------------------------------------------------- many small files


def test_many_files_are_looked_up_and_sniffed_together(spark, write, monkeypatch):
    n = 1100
    root = None
    for i in range(n):
        row = json.dumps({"i": i, "s": "{["})
        text = f" \n[ {row} ]" if i % 3 == 0 else f"\n {row}\n{row}"
        root = write(f"many/d{i}, x/part.json", text).rsplit("/", 2)[0]
    write("many/other/unasked.json", '{"i": -1}')
    asked = []
    find, sniff = files_mod._files, corpus_mod.starts_array
    monkeypatch.setattr(files_mod, "_files", lambda *a: asked.append(a) or find(*a))
    monkeypatch.setattr(corpus_mod, "starts_array", lambda *a: asked.append(a) or sniff(*a))
    how = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(how)
    spec = [f"{root}/d{i}, x" for i in range(n)]
    got = read_json_corpus(spark, [*spec[:600], f"{root}/none", *spec[600:]], literal=True)
    assert len(asked) < 10  # not one for each file, nor for each few names
    assert spark.conf.get(how) == before
    counted = {r["i"]: (r["n"], r["o"]) for r in got.groupBy("i").agg(F.count("*").alias("n"), F.min("_spec_ord").alias("o")).collect()}
    assert counted == {i: (1 if i % 3 == 0 else 2, i + (i >= 600)) for i in range(n)}


def test_many_small_files_are_read_by_few_tasks(spark, write, monkeypatch):
    monkeypatch.setattr(files_mod, "LISTING_TASKS", 16)
    n = 2400
    texts = [b'{"i": %d}\r\n\n{"i": %d, "s": "[\xc3\xbc"}', b' \n[{"i": %d}, {"i": %d, "s": ""}]\n', b'\xef\xbb\xbf{"i": %d}\r{"i": %d}\r']
    for i in range(n):
        root = write(f"few/d{i}/part.json", texts[i % 3] % (i, i + n)).rsplit("/", 2)[0]
    write("few/blank/part.json", b" \n\n")
    write("few/none/part.json", b"[ ]")
    large = write("few/large.json", jl(*[{"i": -1, "pad": "x" * 1000} for _ in range(400)]))
    spec = [f"{root}/{d}" for d in ["blank", *(f"d{i}" for i in range(n)), "none"]] + [large]
    context = spark.sparkContext
    context.setJobGroup("few-tasks", "")
    try:
        got = read_json_corpus(spark, spec).select("i", "s", "pad", "_spec_ord", "_path").collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(j).stageIds]
    tasks = [s.numTasks for s in stages if s is not None and s.name.startswith(("collect", "toArrow", "hasNext"))]
    assert tasks and max(tasks) < 60  # 75, one for each 32 files, before
    small = sorted((r["i"], r["s"], r["_spec_ord"]) for r in got if r["i"] >= 0 and r["s"] is not None)
    assert small == sorted([(i + n, "[ü", i + 1) for i in range(0, n, 3)] + [(i + n, "", i + 1) for i in range(1, n, 3)])
    assert sorted(r["i"] for r in got if r["i"] >= 0) == list(range(2 * n))
    assert [r["_spec_ord"] for r in got if r["pad"]] == [n + 2] * 400


def test_patterns_of_names_none_of_which_exists(spark, write, monkeypatch):
    monkeypatch.setattr(files_mod, "NAMES", 2)
    root = write("few/a.jsonl", '{"i": 1}').rsplit("/", 1)[0]
    write("few/z/b.jsonl", '{"i": 2}')
    names = ["n1", "n2", "a.jsonl", "n3", "n4", "n5", "z"]
    exp = expand_spec(spark, [f"{root}/{n}" for n in names], literal=True)
    assert [f.name for f in exp.files] == ["a.jsonl", "b.jsonl"]
    assert [m.rsplit("/", 1)[1] for m in exp.missing] == ["n1", "n2", "n3", "n4", "n5"]


def test_mixture_fixture_fills_no_task_with_a_language(spark, monkeypatch):
    from collections import defaultdict

    from corpusmill.operators import ordered
    from corpusmill.plans import catalog

    monkeypatch.setattr(ordered, "BYTES", 200_000)
    seen = []
    read = catalog.read_json_corpus
    monkeypatch.setattr(catalog, "read_json_corpus", lambda s, spec: seen.append(spec) or read(s, spec))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = catalog.q_mixture(spark, "/root/testdata/sf0.01").collect()
    english = next(p for p in seen[0].split(";") if p.endswith("lang=en"))
    sizes = [f.length for f in expand_spec(spark, english).files]
    assert len(sizes) > 3 and max(sizes) < 600_000  # one file of 1.5 MB before
    ids = defaultdict(list)
    for lang, i in sorted(rows(docs, "lang", "doc_id")):
        ids[lang].append(i)
    want = [(i, k, place) for k, lang in enumerate([*catalog.LANG_SHARDS, catalog.LANG_SHARDS[0]]) for place, i in enumerate(ids[lang], 1)]
    assert sorted((r["doc_id"], r["spec_ord"], r["place"]) for r in got) == sorted(want)
