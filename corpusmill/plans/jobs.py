"""Job surface: one ``run_job(spark, spec)`` for every task name.

Train tasks return the prepared dataset (lazy) with a ``split`` column; test
tasks return the prediction rows, read back from the file when one is written,
so that the model runs once. Trainer-only settings (learning rate, epochs, ...)
are accepted and carried, never read here: model training runs in the user's
trainer on the prepared data. A setting of ours that the task cannot use raises.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from corpusmill.functions.prompts import CHATML, ChatTemplate, render_column
from corpusmill.functions.tokens import effective_max_length, tokenize
from corpusmill.operators.generate import GenerationConfig, first_words_generator, generate
from corpusmill.operators.preference import PreferenceBudget, load_preference, preference_tokens
from corpusmill.operators.resume import generate_resumable, in_tasks
from corpusmill.operators.split import split_dataset
from corpusmill.sinks.writers import file_row_counts, known_row_counts, write_dataset, write_manifest, write_predictions, write_sidecar
from corpusmill.sources.corpus import read_pretrain_corpus
from corpusmill.sources.json_corpus import META_COLS, read_json_corpus, read_json_files, read_prompt_file, read_train_eval
from corpusmill.sources.paths import expand_spec, join_spec, offline_file_list, route_by_suffix

# Task names, their manifest backends and manifest file names.
TASKS = {
    "train": ("sft", "hf_jsonl", "dataset_manifest.json"),
    "test": ("sft", "hf_jsonl", None),
    "lora_train": ("sft", "hf_jsonl_lora", "dataset_manifest.json"),
    "lora_test": ("sft", "hf_jsonl_lora", None),
    "dpo_train": ("dpo", "hf_jsonl_dpo", "dpo_dataset_manifest.json"),
    "dpo_test": ("dpo", "hf_jsonl_dpo", None),
    "pretrain": ("pretrain", "hf_text", "pretrain_manifest.json"),
    "pretrain_test": ("pretrain", "hf_text", None),
}


@dataclass
class TrainSpec:
    task: str
    train_data_path: str | list
    dev_data_path: str | list | None = None
    dev_split_rate: float = 0.0
    max_seq_len: int = 2048
    prompt_type: str = "chatml"
    seed: int = 42
    max_prompt_length: int = 512
    max_target_length: int = 1536
    work_path: str | None = None
    schema: str | None = None  # DDL of the JSON rows; skips schema inference
    json_layout: str = "auto"  # "lines" or "array" for every .json file; skips sniffing
    manifest_counts: bool = False  # per-file row counts in the manifest (one more scan with a declared schema)
    extra: dict = field(default_factory=dict)


@dataclass
class TestSpec:
    task: str
    test_file: str
    test_output_file: str | None = None
    prompt_type: str = "chatml"
    generate_configs: dict | str | None = None
    lossless: bool = False
    partitions: int | None = None  # model tasks; see operators.generate.generate
    rows_per_task: int | None = None  # or prompts for each of them
    schema: str | None = None  # DDL of the prompt rows; skips schema inference
    json_layout: str = "lines"  # of the prompt file
    resume_path: str | None = None  # a folder of the job's own: a restart goes on there
    extra: dict = field(default_factory=dict)


PROMPTS_PER_TASK = 2048  # a lost model task repeats at most this many

# Settings of ours that some tasks cannot use.
UNUSED = {
    "sft": ("max_prompt_length", "max_target_length"),
    "dpo": ("prompt_type",),
    "pretrain": ("prompt_type", "max_prompt_length", "max_target_length"),
}


def _build(cls, spec: dict):
    names = {f.name for f in fields(cls)} - {"extra"}
    other = {f.name for f in fields(TrainSpec if cls is TestSpec else TestSpec)} - {"extra"} - names
    unused = other if cls is TestSpec else other | set(UNUSED[TASKS[spec["task"]][0]])
    if useless := sorted(unused & spec.keys()):
        raise ValueError(f"task {spec['task']!r} cannot use the settings {useless}")
    return cls(**{k: v for k, v in spec.items() if k in names}, extra={k: v for k, v in spec.items() if k not in names})


def parse_spec(spec: dict) -> TrainSpec | TestSpec:
    task = spec.get("task")
    if task not in TASKS:
        raise ValueError(f"no task named {task!r}")
    if task.endswith("test"):
        if "test_file" not in spec:
            raise ValueError("test tasks need test_file")
        return _build(TestSpec, spec)
    if "train_data_path" not in spec:
        raise ValueError("train tasks need train_data_path")
    return _build(TrainSpec, spec)


def sft_dataset(spark: SparkSession, s: TrainSpec, encoder=None, template=CHATML, custom=None, counts: dict | None = None) -> DataFrame:
    train, held_out = read_train_eval(spark, s.train_data_path, s.dev_data_path, schema=s.schema, layout=s.json_layout, counts=counts)
    data = split_dataset(train, held_out, s.dev_split_rate, seed=s.seed, materialize_keys=True)
    data2, text = render_column(data, s.prompt_type, "train", template, custom)
    keep = ["split"] + [c for c in ("_file_ord", "_block_ord", "_row_ord") if c in data.columns]
    rendered = data2.select(*keep, text.alias("text"))
    return tokenize(rendered, "text", s.max_seq_len, encoder=encoder)


def dpo_dataset(spark: SparkSession, s: TrainSpec, encoder=None, counts: dict | None = None) -> DataFrame:
    data = load_preference(
        spark, s.train_data_path, s.dev_data_path, s.dev_split_rate, seed=s.seed, schema=s.schema, layout=s.json_layout, counts=counts
    )
    budget = PreferenceBudget.job_defaults(s.max_seq_len, s.max_prompt_length, s.max_target_length)
    return preference_tokens(data, budget, encoder)


def pretrain_dataset(spark: SparkSession, s: TrainSpec, encoder=None, counts: dict | None = None) -> DataFrame:
    json_kw = {"schema": s.schema, "layout": s.json_layout, "counts": counts}
    train, held_out = read_pretrain_corpus(spark, s.train_data_path, s.dev_data_path, json_kw=json_kw)
    data = split_dataset(train, held_out, s.dev_split_rate, seed=s.seed, materialize_keys=True)
    return tokenize(data, "text", s.max_seq_len, encoder=encoder, drop_text=True)


def run_job(
    spark: SparkSession,
    spec: dict,
    encoder=None,
    generator: Callable = first_words_generator,
    template: ChatTemplate | None = CHATML,
    custom=None,
) -> DataFrame:
    """``encoder`` is the plug-in tokenizer (``functions.udf.encode_with``),
    ``generator`` the model; chats are rendered with ``template`` (a marker template or
    ``chat_templates.compile_template(text)``), or by a function ``(messages,
    add_generation_prompt) -> text`` given as ``custom``.

    A test job without ``test_output_file`` and ``resume_path`` is lazy: every use of its
    result runs the model, and a sampling model gives other texts. With ``resume_path`` it
    commits predictions as it goes and a restart goes on from there."""
    parsed = parse_spec(spec)
    kind, backend, manifest = TASKS[parsed.task]
    if kind != "sft" and not isinstance(parsed, TestSpec) and custom is not None:
        raise ValueError(f"task {parsed.task!r} renders no chats: custom= cannot be used")
    if isinstance(parsed, TestSpec):
        return _test_job(spark, parsed, generator, template, custom)
    seen: dict | None = {} if parsed.manifest_counts else None  # rows of each file, where inference passes over them
    if kind == "sft":
        out = sft_dataset(spark, parsed, encoder, template, custom, seen)
    elif kind == "dpo":
        out = dpo_dataset(spark, parsed, encoder, seen)
    else:
        out = pretrain_dataset(spark, parsed, encoder, seen)
    if parsed.work_path:
        exp = expand_spec(spark, parsed.train_data_path)
        counts = None
        if seen:
            js, tx, _ = route_by_suffix(exp.files) if kind == "pretrain" else (exp.files, [], [])
            counts = known_row_counts(spark, js, {uri: n for (side, uri), n in seen.items() if side == 0}, tx)
        elif parsed.manifest_counts:
            how = {"schema": parsed.schema, "layout": parsed.json_layout}
            if kind == "pretrain":
                scanned = read_pretrain_corpus(spark, parsed.train_data_path, json_kw=how)[0]
            else:
                scanned = read_json_corpus(spark, parsed.train_data_path, **how)
            counts = file_row_counts(scanned)
        write_manifest(
            spark,
            f"{parsed.work_path.rstrip('/')}/process_data/{manifest}",
            join_spec(parsed.train_data_path),
            backend,
            counts=counts,
            missing=exp.missing,
            options=parsed.extra,
        )
    return out


def _test_job(spark: SparkSession, s: TestSpec, generator: Callable, template, custom) -> DataFrame:
    rows = read_prompt_file(spark, s.test_file, lossless=s.lossless, schema=s.schema, layout=s.json_layout)
    config = GenerationConfig.parse(s.generate_configs)
    per_task = s.rows_per_task or PROMPTS_PER_TASK
    if s.resume_path:
        done = generate_resumable(
            rows, s.resume_path, generator, config, s.prompt_type, per_task, s.partitions, template=template, custom=custom
        )
        out = in_tasks(done, per_task)
    else:
        out = generate(
            rows,
            generator,
            config,
            s.prompt_type,
            template,
            custom,
            partitions=s.partitions,
            # contiguous stretches of the input: the output files read back in its order
            rows_per_task=per_task,
        )
    if not s.test_output_file:
        return out
    write_predictions(out, s.test_output_file, lossless=s.lossless)
    kept = [f for f in out.schema.fields if f.name not in META_COLS + ("_raw",)]
    return spark.read.schema(T.StructType(kept)).json(s.test_output_file)


def offline_preprocess(
    spark: SparkSession,
    input_spec: str,
    output_prefix: str,
    *,
    tokenizer: str = "codepoints",
    encoder=None,
    model_max_length: int | None = None,
    task: str = "sft",
    question_max_length: int = 10000,
    question_truncation_side: str = "right",
    model_type: str | None = None,
    prompt_type: str = "chatml",
    template=CHATML,
    custom=None,
    schema: str | None = None,
    json_layout: str = "auto",
    partition_by: tuple[str, ...] | None = None,
) -> DataFrame:
    """Offline tool: literal file list, render, tokenize with labels, keep only
    the token columns, write the dataset and its sidecar; returns the written
    dataset read back."""
    files = offline_file_list(spark, input_spec)
    data = read_json_files(spark, files.files, schema=schema, layout=json_layout)
    max_len = effective_max_length(question_max_length, model_max_length)
    data2, text = render_column(data, prompt_type, "train", template, custom)
    rendered = data2.select(text.alias("text"))
    out = tokenize(rendered, "text", max_len, question_truncation_side, encoder=encoder, labels=True, drop_text=True)
    write_dataset(out, output_prefix, partition_by)
    write_sidecar(
        spark,
        output_prefix,
        {
            "task": task,
            "tokenizer": tokenizer,
            "model_type": model_type,
            "prompt_type": prompt_type,
            "truncation_side": question_truncation_side,
        },
    )
    return spark.read.parquet(output_prefix)
