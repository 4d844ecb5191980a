"""Prompt rendering against written-out texts."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from render_cases import EDGE_ROWS, chat, texts

from corpusmill.functions.prompts import CHATML, ChatTemplate, chat_text, render
from corpusmill.functions.schema import has_messages, require_columns, with_optional_columns
from corpusmill.sources.json_corpus import read_json_corpus

@pytest.fixture
def edge_df(spark, write):
    p = write("edge.jsonl", "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in EDGE_ROWS))
    return read_json_corpus(spark, p)


@pytest.mark.parametrize("prompt_type", ["chatml", "alpaca", "something-else"])
@pytest.mark.parametrize("mode", ["train", "prompt"])
def test_render_matches_python(edge_df, prompt_type, mode):
    got = dict(rows(render(edge_df, prompt_type, mode, keep=("id",)), "id", "text"))
    assert got == texts(prompt_type, mode)


@pytest.mark.parametrize("mode", ["train", "prompt"])
def test_plain_fallback_without_template(spark, write, mode):
    inst_rows = [r for r in EDGE_ROWS if "messages" not in r]
    p = write("inst.jsonl", "".join(json.dumps(r) + "\n" for r in inst_rows))
    df = read_json_corpus(spark, p)
    got = dict(rows(render(df, "chatml", mode, template=None, keep=("id",)), "id", "text"))
    want = texts("plain", mode)
    assert got == {r["id"]: want[r["id"]] for r in inst_rows}


def test_messages_rows_need_a_template(edge_df):
    with pytest.raises(Exception, match="chat template"):
        render(edge_df, "chatml", "train", template=None).collect()
    no_chat = edge_df.where(~has_messages(edge_df))
    got = dict(rows(render(no_chat, "chatml", "train", template=None, keep=("id",)), "id", "text"))
    assert got == texts("plain", "train")


def test_every_row_rendered_none_dropped_none_null(edge_df):
    out = render(edge_df, "chatml", "train", keep=())
    assert out.columns == ["text"]
    assert out.count() == len(EDGE_ROWS)
    assert out.where(F.col("text").isNull()).count() == 0


def test_keep_none_keeps_every_column(edge_df):
    out = render(edge_df, "alpaca", "train")
    assert set(edge_df.columns) <= set(out.columns) and "text" in out.columns


def test_has_messages_null_and_empty_are_absent(edge_df):
    got = dict(rows(edge_df.select("id", has_messages(edge_df).alias("m")), "id", "m"))
    assert [k for k, v in sorted(got.items()) if v] == [4, 7]


def test_has_messages_absent_column(spark):
    df = spark.createDataFrame([(1,)], "id int")
    assert rows(df.select(has_messages(df))) == [(False,)]


def test_custom_template_parity_with_native(spark, edge_df):
    from corpusmill.functions.udf import custom_chat

    df = edge_df.where(has_messages(edge_df))
    for gen in (False, True):
        native = chat_text(F.col("messages"), CHATML, gen)
        custom = custom_chat(chat, gen)(F.col("messages"), F.lit(None).cast("string"))
        diff = df.select((native == custom).alias("same")).where(~F.col("same")).count()
        assert diff == 0


def test_custom_renderer_falls_back_on_instruction_rows(spark, edge_df):
    def picky(msgs, gen):
        if any(m["role"] == "assistant" for m in msgs):
            raise ValueError("no assistant turns")
        return chat(msgs, gen)

    out = render(edge_df.where(~has_messages(edge_df)), "chatml", "train", custom=picky, keep=("id",))
    got = dict(rows(out, "id", "text"))
    assert got == texts("plain", "train")


def test_custom_renderer_failure_on_messages_raises(spark, edge_df):
    def broken(msgs, gen):
        raise RuntimeError("template failed")

    out = render(edge_df.where(has_messages(edge_df)), "chatml", "train", custom=broken, keep=("id",))
    with pytest.raises(Exception, match="template failed"):
        out.collect()


def test_template_is_data(spark):
    tpl = ChatTemplate(prefix="[", role_sep="]: ", suffix="\n", default_system="sys!")
    df = spark.createDataFrame(
        [(1, [("hi", "user")]), (2, [("s", "system"), ("q", "user")])],
        "id int, messages array<struct<content:string,role:string>>",
    )
    got = dict(rows(df.select("id", chat_text(F.col("messages"), tpl, True).alias("t"))))
    assert got == {1: "[system]: sys!\n[user]: hi\n[assistant]: ", 2: "[system]: s\n[user]: q\n[assistant]: "}


def test_schema_gates(spark):
    df = spark.createDataFrame([("a",)], "prompt string")
    with pytest.raises(ValueError, match="chosen"):
        require_columns(df, "prompt", "chosen", "rejected")
    assert with_optional_columns(df, ["prompt", "x"]).dtypes == [("prompt", "string"), ("x", "string")]


def test_render_plan_stays_in_the_jvm(edge_df):
    plan = render(edge_df, "chatml", "train", keep=("id",))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_default_system_on_empty_and_null_lists(spark):
    tpl = ChatTemplate(prefix="[", role_sep="]: ", suffix="\n", default_system="sys!")
    df = spark.createDataFrame([(1, []), (2, None)], "id int, messages array<struct<content:string,role:string>>")
    got = dict(rows(df.select("id", chat_text(F.col("messages"), tpl).alias("t"))))
    assert got == {1: "[system]: sys!\n", 2: None}


def test_messages_column_of_empty_lists_only(spark, write):
    p = write("empty_msgs.jsonl", json.dumps({"id": 1, "instruction": "q", "messages": []}) + "\n")
    df = read_json_corpus(spark, p)
    assert dict(df.dtypes)["messages"] == "array<string>"
    got = rows(render(df, "chatml", "train", keep=("id",)), "id", "text")
    assert got == [(1, "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")]
    bad = write("str_msgs.jsonl", json.dumps({"id": 2, "messages": ["hi"]}) + "\n")
    with pytest.raises(Exception, match="role, content"):
        render(read_json_corpus(spark, bad), "chatml", "train").collect()
