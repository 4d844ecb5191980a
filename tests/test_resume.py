"""Generation that goes on after a failure."""

from __future__ import annotations

import json
import os
from collections import Counter

import pytest
from conftest import rows

from corpusmill.operators.generate import first_words_generator, generate
from corpusmill.operators.resume import generate_resumable
from corpusmill.plans.jobs import run_job
from corpusmill.sources.json_corpus import ORDER_COLS, read_prompt_file


def jl(*objs) -> str:
    return "".join(json.dumps(o, ensure_ascii=False) + "\n" for o in objs)


def flaky(log: str, broken: str, bad: str):
    """Notes each prompt it answers; fails on ``bad`` while the file ``broken`` is there."""

    def factory(config):
        def gen(prompts):
            out = []
            for p in prompts:
                name = p.split("\n")[1].split()[0]
                if name == bad and os.path.exists(broken):
                    raise RuntimeError(f"out of memory at {name}")
                with open(log, "a") as f:
                    f.write(f"{name}\n")
                out.append(f" {name}! ")
            return out

        return gen

    return factory


def test_a_failed_generation_goes_on(spark, write, tmp_path):
    src = write("p.jsonl", jl(*[{"i": i, "instruction": f"w{i} x"} for i in range(60)]))
    log, broken, work = str(tmp_path / "log"), str(tmp_path / "broken"), str(tmp_path / "work")
    open(broken, "w").close()
    model = flaky(log, broken, "w37")
    prompts = read_prompt_file(spark, src)
    with pytest.raises(Exception, match="out of memory at w37"):
        generate_resumable(prompts, work, model, rows_per_task=5, tasks_per_commit=3)
    first = Counter(open(log).read().split())
    assert 0 < len(first) < 60
    committed = {r[0] for r in rows(spark.read.schema(prompts.schema).parquet(f"{work}/predictions"), "i")}
    assert len(committed) in (15, 30, 45) and 37 not in committed
    os.remove(broken)
    out = generate_resumable(prompts, work, model, rows_per_task=5, tasks_per_commit=3)
    got = rows(out, "i", "prediction", order=list(ORDER_COLS))
    assert got == [(i, f"w{i}!") for i in range(60)]
    calls = Counter(open(log).read().split())
    assert set(calls) == {f"w{i}" for i in range(60)}
    assert all(calls[f"w{i}"] == 1 for i in committed)  # none of them was asked again
    assert sum(n - 1 for n in calls.values()) <= 15  # at most one micro-batch was repeated
    again = generate_resumable(prompts, work, model, rows_per_task=5, tasks_per_commit=3)
    assert again.count() == 60 and Counter(open(log).read().split()) == calls


def test_rows_equal_those_of_a_plain_generation(spark, write, tmp_path):
    src = write("p.jsonl", jl({"instruction": "a b c", "prediction": "old", "n": 1}, {"messages": [{"role": "user", "content": "hey"}]}, {"instruction": "é"}))
    prompts = read_prompt_file(spark, src)
    out = generate_resumable(prompts, str(tmp_path / "w"), first_words_generator, {"max_new_tokens": 2})
    plain = generate(prompts, first_words_generator, {"max_new_tokens": 2})
    assert out.columns == plain.columns
    cols = ["n", "prediction", "_path", *ORDER_COLS]
    assert rows(out, *cols, order=list(ORDER_COLS)) == rows(plain, *cols, order=list(ORDER_COLS))


def test_other_settings_raise(spark, write, tmp_path):
    prompts = read_prompt_file(spark, write("p.jsonl", jl({"instruction": "a"})))
    work = str(tmp_path / "w")
    generate_resumable(prompts, work, first_words_generator, {"max_new_tokens": 2})
    with pytest.raises(ValueError, match="other settings"):
        generate_resumable(prompts, work, first_words_generator, {"max_new_tokens": 3})


def test_no_prompts(spark, tmp_path):
    df = spark.createDataFrame([], "instruction string")
    assert generate_resumable(df, str(tmp_path / "w")).collect() == []


def test_job_resumes_and_keeps_the_input_order(spark, write, tmp_path):
    src = write("p.jsonl", jl(*[{"i": i, "instruction": f"w{i} x"} for i in range(40)]))
    log, broken = str(tmp_path / "log"), str(tmp_path / "broken")
    for lossless in (False, True):
        open(broken, "w").close()
        dest, work = str(tmp_path / f"out{lossless}"), str(tmp_path / f"work{lossless}")
        spec = {"task": "test", "test_file": src, "test_output_file": dest, "rows_per_task": 4, "partitions": 2, "resume_path": work, "lossless": lossless}
        model = flaky(log, broken, "w25")
        with pytest.raises(Exception, match="out of memory"):
            run_job(spark, spec, generator=model)
        assert not os.path.exists(dest)
        os.remove(broken)
        out = run_job(spark, spec, generator=model)
        assert out.count() == 40
        lines = []
        for name in sorted(n for n in os.listdir(dest) if n.startswith("part-")):
            with open(os.path.join(dest, name)) as f:
                lines += [json.loads(x) for x in f if x.strip()]
        assert [(x["i"], x["prediction"]) for x in lines] == [(i, f"w{i}!") for i in range(40)]
