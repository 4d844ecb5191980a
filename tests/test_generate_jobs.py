"""Batch generation, sinks and the job surface."""

from __future__ import annotations

import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corpusmill.operators.generate import GenerationConfig, first_words_generator, generate
from corpusmill.plans.jobs import TestSpec as PromptJobSpec
from corpusmill.plans.jobs import TrainSpec, parse_spec, run_job
from corpusmill.sinks.writers import read_manifest, write_predictions
from corpusmill.sources.json_corpus import read_prompt_file


def jl(*objs) -> str:
    return "".join(json.dumps(o, ensure_ascii=False) + "\n" for o in objs)


def part_lines(path: str) -> list[str]:
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            with open(os.path.join(path, name), encoding="utf-8") as fh:
                out.extend(line.rstrip("\n") for line in fh if line.strip())
    return out


# ------------------------------------------------------------------ I2


def test_generation_config_defaults_and_parsing():
    assert GenerationConfig.parse(None) == GenerationConfig(256, 0.7, 0.9, True)
    assert GenerationConfig.parse("") == GenerationConfig()
    assert GenerationConfig.parse('{"max_new_tokens": 8, "do_sample": "false"}') == GenerationConfig(8, 0.7, 0.9, False)
    assert GenerationConfig.parse({"temperature": "0.2", "do_sample": 0}).do_sample is False
    with pytest.raises(json.JSONDecodeError):
        GenerationConfig.parse("{not json")
    with pytest.raises(ValueError):
        GenerationConfig.parse("[1, 2]")


# ------------------------------------------------------------------ I1 / I3 / P4


def padded(config):
    return lambda prompts: [f"  \t{p.split()[0]} \n" for p in prompts]


def test_generate_appends_and_overwrites_prediction(spark):
    df = spark.createDataFrame(
        [(1, "say hello", "stale"), (2, "two words", None)], "id int, instruction string, prediction string"
    )
    out = generate(df, padded, {"max_new_tokens": 4}, prompt_type="alpaca")
    assert out.columns == ["id", "instruction", "prediction"]
    assert dict(rows(out, "id", "prediction")) == {1: "Below", 2: "Below"}


def test_generate_renders_prompt_mode(spark):
    df = spark.createDataFrame([(1, "hi there")], "id int, instruction string")
    out = generate(df, first_words_generator, {"max_new_tokens": 50}, keep_prompt=True)
    r = out.first()
    assert r["prompt_text"] == "<|im_start|>user\nhi there<|im_end|>\n<|im_start|>assistant\n"
    assert r["prediction"] == "<|im_start|>user hi there<|im_end|> <|im_start|>assistant"


def test_generator_built_once_per_worker_and_length_checked(spark):
    def short(config):
        return lambda prompts: prompts[:-1]

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, instruction string").coalesce(1)
    with pytest.raises(Exception, match="generator returned"):
        generate(df, short).collect()


def test_only_prompt_crosses_to_python(spark):
    df = spark.createDataFrame([(1, "a", "big payload")], "id int, instruction string, payload string")
    plan = generate(df, first_words_generator)._jdf.queryExecution().executedPlan().toString()
    arrow = [line for line in plan.splitlines() if "ArrowEvalPython" in line]
    assert arrow and "payload" not in arrow[0]


# ------------------------------------------------------------------ I4 / I5 / W3


def test_lossless_sink_keeps_keys_order_nulls_and_overwrites_in_place(spark, write, tmp_path):
    src = write(
        "p.jsonl",
        '{"z": 1, "prediction": "old", "instruction": "first prompt", "n": null}\n\n'
        '{"instruction": "second one", "é": "ü"}\n',
    )
    rows_ = read_prompt_file(spark, src, lossless=True)
    dest = str(tmp_path / "out")
    write_predictions(generate(rows_, first_words_generator, {"max_new_tokens": 2}), dest, lossless=True)
    lines = part_lines(dest)
    assert lines == [
        '{"z": 1, "prediction": "<|im_start|>user first", "instruction": "first prompt", "n": null}',
        '{"instruction": "second one", "é": "ü", "prediction": "<|im_start|>user second"}',
    ]


def test_typed_sink_keeps_nulls_and_input_order(spark, write, tmp_path):
    src = write("p.jsonl", jl(*[{"i": i, "instruction": f"w{i} x", "opt": None} for i in range(50)]))
    rows_ = read_prompt_file(spark, src)
    dest = str(tmp_path / "out")
    write_predictions(generate(rows_, first_words_generator, {"max_new_tokens": 1}), dest)
    lines = [json.loads(x) for x in part_lines(dest)]
    assert [d["i"] for d in lines] == list(range(50))
    assert all("opt" in d and d["opt"] is None for d in lines)
    assert not any(k.startswith("_") for d in lines for k in d)


# ------------------------------------------------------------------ J1 / J2 / W4


def test_unknown_task_fails():
    with pytest.raises(ValueError, match="no task"):
        parse_spec({"task": "finetune", "train_data_path": "x"})
    with pytest.raises(ValueError, match="train_data_path"):
        parse_spec({"task": "train"})
    with pytest.raises(ValueError, match="test_file"):
        parse_spec({"task": "test"})


def test_job_defaults_and_trainer_knobs_carried():
    s = parse_spec({"task": "pretrain", "train_data_path": "a", "learning_rate": 1e-4, "epochs": 2})
    assert isinstance(s, TrainSpec)
    assert (s.dev_data_path, s.dev_split_rate, s.max_seq_len, s.prompt_type) == (None, 0.0, 2048, "chatml")
    assert s.extra == {"learning_rate": 1e-4, "epochs": 2}
    t = parse_spec({"task": "lora_test", "test_file": "x"})
    assert isinstance(t, PromptJobSpec) and t.test_output_file is None


def test_train_job_with_manifest(spark, write, tmp_path):
    tr = write("tr.jsonl", jl(*[{"instruction": f"q{i}", "output": f"a{i}"} for i in range(20)]))
    work = str(tmp_path / "work")
    out = run_job(
        spark,
        {"task": "train", "train_data_path": f"{tr};{tmp_path}/gone.jsonl", "dev_split_rate": 0.25, "work_path": work, "max_seq_len": 16,
         "learning_rate": 2e-5, "epochs": 3},
    )
    assert dict(rows(out.groupBy("split").count())) == {"train": 15, "eval": 5}
    assert out.where(F.size("input_ids") > 16).count() == 0
    head, _ = read_manifest(spark, f"{work}/process_data/dataset_manifest.json")
    assert head["backend"] == "hf_jsonl"
    assert json.loads(head["missing"]) == [f"{tmp_path}/gone.jsonl"]
    assert json.loads(head["options"]) == {"learning_rate": 2e-5, "epochs": 3}


def test_pretrain_job_eval_spec_falls_through_to_rate(spark, write, tmp_path):
    tr = write("docs.jsonl", jl(*[{"text": f"doc {i}", "k": i} for i in range(40)]))
    out = run_job(
        spark, {"task": "pretrain", "train_data_path": tr, "dev_data_path": f"{tmp_path}/none.jsonl", "dev_split_rate": 0.1}
    )
    assert "text" not in out.columns and "k" in out.columns
    assert dict(rows(out.groupBy("split").count())) == {"train": 36, "eval": 4}


def test_test_job_output_in_input_order_across_splits(spark, write, tmp_path):
    src = write("order.jsonl", jl(*[{"i": i, "instruction": f"w{i} " + "z" * 60} for i in range(3000)]))
    dest = str(tmp_path / "pred")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")  # many input splits, packed out of order
    try:
        run_job(spark, {"task": "test", "test_file": src, "test_output_file": dest, "generate_configs": {"max_new_tokens": 1}})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [json.loads(x)["i"] for x in part_lines(dest)] == list(range(3000))


def test_test_job_writes_predictions(spark, write, tmp_path):
    src = write("prompts.jsonl", jl({"instruction": "one two three"}, {"messages": [{"role": "user", "content": "hey you"}]}))
    dest = str(tmp_path / "pred")
    run_job(spark, {"task": "test", "test_file": src, "test_output_file": dest, "generate_configs": {"max_new_tokens": 3}})
    preds = [json.loads(x)["prediction"] for x in part_lines(dest)]
    assert preds == ["<|im_start|>user one two", "<|im_start|>user hey you<|im_end|>"]


def test_train_job_with_declared_schema(spark, write):
    tr = write("typed.jsonl", jl({"instruction": "q", "output": "a", "junk": 1}))
    out = run_job(spark, {"task": "train", "train_data_path": tr, "schema": "instruction string, output string"})
    assert rows(out, "text") == [("<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n",)]


def test_generation_partitions_are_kept_as_given(spark, write, tmp_path):
    src = write("many.jsonl", jl(*[{"i": i, "instruction": f"w{i} x"} for i in range(60)]))
    rows_ = read_prompt_file(spark, src)
    out = generate(rows_, first_words_generator, {"max_new_tokens": 1}, partitions=6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(_file_ord" in plan.lower() and ", 6)" in plan
    dest = str(tmp_path / "out")
    write_predictions(out, dest)
    parts = [n for n in os.listdir(dest) if n.startswith("part-")]
    assert len(parts) == 6
    # the output files, read in name order, are the input order
    assert [json.loads(x)["i"] for x in part_lines(dest)] == list(range(60))
    plain = spark.createDataFrame([(i, f"w{i}") for i in range(20)], "i int, instruction string")
    rr = generate(plain, first_words_generator, {"max_new_tokens": 1}, partitions=4)
    assert "RoundRobinPartitioning(4)" in rr._jdf.queryExecution().executedPlan().toString()


def test_manifest_with_per_file_counts(spark, write, tmp_path):
    a = write("c/a.jsonl", jl(*[{"text": f"a{i}"} for i in range(7)]))
    b = write("c/b.jsonl", jl(*[{"text": f"b{i}"} for i in range(3)]))
    t = write("c/t.txt", "whole file")
    work = str(tmp_path / "w")
    run_job(spark, {"task": "pretrain", "train_data_path": f"{a};{b};{t}", "work_path": work, "manifest_counts": True})
    head, files = read_manifest(spark, f"{work}/process_data/pretrain_manifest.json")
    assert head["backend"] == "hf_text"
    assert rows(files.select("file_ord", "rows"), order=["file_ord"]) == [(0, 7), (1, 3), (2, 1)]


@pytest.mark.parametrize("declared", [None, "text string"])
def test_manifest_counts_come_from_the_inference_pass(spark, write, tmp_path, monkeypatch, declared):
    from corpusmill.plans import jobs

    a = write("c/a.jsonl", jl(*[{"text": f"a{i}"} for i in range(7)]))
    b = write("c/b.json", json.dumps([{"text": f"b{i}"} for i in range(3)]))
    e = write("c/none.jsonl", "\n")
    t = write("c/t.txt", "whole file")
    scans = []
    whole = jobs.file_row_counts
    monkeypatch.setattr(jobs, "file_row_counts", lambda df: scans.append(1) or whole(df))
    work = str(tmp_path / "w")
    spec = {"task": "pretrain", "train_data_path": f"{b};{t};{a};{e};{a}", "work_path": work, "manifest_counts": True, "dev_data_path": b}
    run_job(spark, spec | ({"schema": declared} if declared else {}))
    _, files = read_manifest(spark, f"{work}/process_data/pretrain_manifest.json")
    got = [(o, s, None if p is None else p.rsplit("/", 1)[-1], n) for o, s, p, n in rows(files, "file_ord", "spec_ord", "path", "rows", order=["file_ord"])]
    assert got == [(0, 0, "b.json", 3), (1, 2, "a.jsonl", 7), (3, 4, "a.jsonl", 7), (4, 1, None, 1)]
    assert len(scans) == (1 if declared else 0)


def test_declared_json_layout_skips_sniffing(spark, write):
    a = write("lay/a.json", json.dumps([{"text": "x"}, {"text": "y"}]))
    out = run_job(spark, {"task": "pretrain", "train_data_path": a, "json_layout": "array"})
    assert out.count() == 2


def test_settings_a_task_cannot_use_raise():
    for spec, name in (
        ({"task": "pretrain", "train_data_path": "a", "prompt_type": "alpaca"}, "prompt_type"),
        ({"task": "train", "train_data_path": "a", "max_target_length": 3}, "max_target_length"),
        ({"task": "train", "train_data_path": "a", "lossless": True}, "lossless"),
        ({"task": "test", "test_file": "a", "dev_split_rate": 0.1}, "dev_split_rate"),
    ):
        with pytest.raises(ValueError, match=name):
            parse_spec(spec)


def test_filter_on_predictions_runs_the_model_once(spark):
    df = spark.createDataFrame([(i, f"w{i}") for i in range(20)], "i int, instruction string")
    out = generate(df, first_words_generator, {"max_new_tokens": 3}).where(F.col("prediction").contains("w1"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def counting(path):
    def factory(config):
        def gen(prompts):
            with open(path, "a") as f:
                f.write("x" * len(prompts))
            return [f"{len(prompts)}" for _ in prompts]

        return gen

    return factory


def test_job_returns_what_it_wrote_without_running_the_model_again(spark, write, tmp_path):
    calls = tmp_path / "calls"
    src = write("ten.jsonl", jl(*[{"i": i, "instruction": f"w{i}"} for i in range(10)]))
    for lossless in (False, True):
        calls.write_text("")
        dest = str(tmp_path / f"out{lossless}")
        out = run_job(spark, {"task": "test", "test_file": src, "test_output_file": dest, "lossless": lossless}, generator=counting(str(calls)))
        assert out.count() == 10 and out.columns == ["i", "instruction", "prediction"]
        assert out.where("prediction is null").count() == 0
        assert len(calls.read_text()) == 10


def test_job_with_a_custom_renderer_and_eval_of_another_shape(spark, write):
    tr = write("tr.jsonl", jl({"messages": [{"role": "user", "content": "hi"}], "n": 1}))
    dv = write("dv.jsonl", jl({"messages": [], "instruction": "q", "output": "a"}, {"messages": None, "instruction": "r", "output": "b"}))
    render = lambda msgs, gen: "|".join(m["content"] for m in msgs)
    out = run_job(spark, {"task": "train", "train_data_path": tr, "dev_data_path": dv}, custom=render)
    assert rows(out, "split", "text", order=["split", "text"]) == [("eval", "q|a"), ("eval", "r|b"), ("train", "hi")]
    out = run_job(spark, {"task": "test", "test_file": dv}, custom=render, generator=lambda c: lambda ps: ps)
    assert rows(out, "prediction", order=["prediction"]) == [("q",), ("r",)]


def test_dpo_job_reads_the_declared_schema_only(spark, write, tmp_path):
    tr = write("p.jsonl", jl({"prompt": "p" * 600, "chosen": "c", "rejected": "r", "n": 3}))
    work = str(tmp_path / "dpo")
    out = run_job(spark, {"task": "dpo_train", "train_data_path": tr, "max_seq_len": 256, "schema": "prompt string, chosen string, rejected string",
                          "json_layout": "lines", "work_path": work})
    assert "n" not in out.columns
    r = out.first()
    assert len(r["prompt_input_ids"]) == 256 and r["chosen_input_ids"] == [] and r["rejected_input_ids"] == []
    assert read_manifest(spark, f"{work}/process_data/dpo_dataset_manifest.json")[0]["backend"] == "hf_jsonl_dpo"
