"""Registered queries: one per operator of the inventory, keyed by its name.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over whole tables.
Queries about files first write their input from the tables into a fresh
folder under the shared checkpoint root, then read it back through the
operator. Outputs are scalars (counts, sums, hashes, joined heads) so that the
value comparison does not depend on list formatting.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.prompts import (
    CHATML,
    alpaca_text,
    chat_text,
    instruction_fields,
    instruction_messages,
    render,
    user_turn,
)
from corpusmill.functions.schema import has_messages
from corpusmill.functions.tokens import encode_codepoints, tokenize, truncate
from corpusmill.functions.udf import batch_map, custom_chat, encode_with
from corpusmill.operators.generate import GenerationConfig, first_words_generator, generate
from corpusmill.operators.ordered import next_in_group, range_partitions, running_sum
from corpusmill.operators.preference import PreferenceBudget, load_preference, preference_tokens
from corpusmill.operators.runlog import number_runs, phase_durations, read_run_logs, run_outcomes
from corpusmill.operators.split import assign_split, split_dataset
from corpusmill.plans import fixtures as fx
from corpusmill.plans.flagship import chat_training_set
from corpusmill.plans.jobs import offline_preprocess, run_job
from corpusmill.sinks.writers import (
    SIDECAR_FIELDS,
    file_row_counts,
    read_manifest,
    read_sidecar,
    write_dataset,
    write_manifest,
    write_predictions,
)
from corpusmill.sources.corpus import read_pretrain_corpus
from corpusmill.sources.files import list_files_recursive
from corpusmill.sources.json_corpus import ORDER_COLS, read_json_corpus, read_json_files, read_prompt_file, read_train_eval
from corpusmill.sources.paths import expand_spec
from corpusmill.sources.text_corpus import read_text_files

LANG_SHARDS = ("de", "en", "es", "fr")  # mixture shards, listed in this order, then "de" again
GEN = GenerationConfig(max_new_tokens=8)


# ---------------------------------------------------------------- helpers


def _jsonl(spark: SparkSession, df: DataFrame, label: str) -> str:
    return fx.write_jsonl(df, fx.fixture_dir(spark, label))


def _n(ids: Column) -> Column:
    return F.size(ids).cast("bigint")


def _digest(ids: Column) -> Column:
    """Every id in its place: md5 of the ids joined by spaces."""
    return F.md5(F.array_join(ids.cast("array<string>"), " "))


def _ids_cols(name: str) -> list[Column]:
    return [_n(F.col(name)).alias("n"), _digest(F.col(name)).alias("ids_md5")]


def _msg_count(name: str = "messages") -> Column:
    return F.when(F.col(name).isNull(), F.lit(0)).otherwise(F.size(name)).cast("bigint")


def _docs(spark, sf_dir) -> DataFrame:
    return fx.table(spark, sf_dir, "documents")


def _inst_cols(df: DataFrame):
    return instruction_fields(df)


# ---------------------------------------------------------------- flagship


def q_flagship(spark, sf_dir):
    return chat_training_set(spark, sf_dir)


# ---------------------------------------------------------------- sources


def q_jsonl_scan(spark, sf_dir):
    d = _jsonl(spark, _docs(spark, sf_dir), "docs-jsonl")
    df = read_json_corpus(spark, d)
    return df.select("doc_id", F.length("text").cast("bigint").alias("n"), F.md5("text").alias("h"), "n_chars")


def _write_array_files(spark: SparkSession, df: DataFrame, key: str, per_file: int, label: str) -> str:
    """Pretty-printed top-level JSON arrays, ``per_file`` rows each."""
    out = fx.fixture_dir(spark, label)
    item = F.to_json(F.struct(*df.columns))
    arrays = df.groupBy(F.floor(F.col(key) / per_file).alias("bucket")).agg(
        F.concat(
            F.lit("[\n  "),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), item.alias("j")))), lambda x: x["j"]),
                ",\n  ",
            ),
            F.lit("\n]"),
        ).alias("value")
    )
    arrays.write.partitionBy("bucket").text(out)
    for f in list_files_recursive(spark, out):
        if f.name.endswith(".txt") and not f.name.startswith("."):
            fx.rename(spark, f.path, f.path[: -len(".txt")] + ".json")
    return out


def q_json_dataset(spark, sf_dir):
    bench = fx.table(spark, sf_dir, "benchmark")
    root = _write_array_files(spark, bench, "item_id", 16, "bench-array")
    dirs = sorted({f.path.rsplit("/", 1)[0] for f in list_files_recursive(spark, root) if f.name.endswith(".json")})
    df = read_json_corpus(spark, ";".join(dirs))
    return df.select("item_id", F.md5("text").alias("h"))


def _lang_shards(spark, sf_dir) -> str:
    root = fx.fixture_dir(spark, "docs-by-lang")
    _docs(spark, sf_dir).write.partitionBy("lang").json(root)
    return root


def q_mixture(spark, sf_dir):
    root = fx.fixture_dir(spark, "docs-in-order")
    docs = _docs(spark, sf_dir)
    # a language's files follow each other by doc_id, one for each task that its rows need
    docs.repartitionByRange(range_partitions(docs), "lang", "doc_id").sortWithinPartitions("lang", "doc_id").write.partitionBy("lang").json(root)
    spec = ";".join([f"{root}/lang={x}" for x in LANG_SHARDS] + [f"{root}/lang={LANG_SHARDS[0]}"])
    # the place of each row in its part of the mixture, as the files have them
    df = running_sum(read_json_corpus(spark, spec), ["_spec_ord"], list(ORDER_COLS), F.lit(1).cast("bigint"), "place")
    return df.select("doc_id", F.length("text").cast("bigint").alias("n"), F.col("_spec_ord").alias("spec_ord"), "place")


def _text_files(spark, sf_dir) -> list:
    root = fx.fixture_dir(spark, "bench-txt")
    fx.table(spark, sf_dir, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(root)
    return [f for f in list_files_recursive(spark, root) if f.name.endswith(".txt") and not f.name.startswith(".")]


def q_whole_text(spark, sf_dir):
    files = _text_files(spark, sf_dir)
    exp = expand_spec(spark, [f.path for f in files], literal=True)
    df = read_text_files(spark, exp.files, with_path=True)
    item = F.regexp_extract(F.col("_path"), r"item_id=(\d+)", 1).cast("bigint")
    return df.select(item.alias("item_id"), F.md5("text").alias("h"))


def q_union_chunks(spark, sf_dir):
    d = _jsonl(spark, _docs(spark, sf_dir).select("doc_id", "text"), "docs-jsonl")
    files = _text_files(spark, sf_dir)
    df, _ = read_pretrain_corpus(spark, [d] + [f.path for f in files])
    return df.select(F.md5("text").alias("h"), "doc_id")


def _prompt_rows(spark, sf_dir) -> DataFrame:
    """Open conversations plus instruction prompts (answers removed)."""
    chats = fx.open_chat_rows(spark, sf_dir).withColumn("turn", F.lit(-1).cast("bigint"))
    inst = fx.instruction_rows(spark, sf_dir).drop("output", "response")
    return chats.unionByName(inst, allowMissingColumns=True)


def q_prompt_file(spark, sf_dir):
    d = _jsonl(spark, _prompt_rows(spark, sf_dir), "prompts")
    df = read_prompt_file(spark, d, lossless=True)
    inst, inp, _ = _inst_cols(df)
    return df.select(
        "conv_id",
        "turn",
        _msg_count().alias("n_msgs"),
        inst.alias("inst"),
        F.array_join(F.json_object_keys("_raw"), ",").alias("keys"),
    )


# ---------------------------------------------------------------- gates and projections


def q_has_messages(spark, sf_dir):
    d = _jsonl(spark, fx.mixed_sft_rows(spark, sf_dir), "mixed-sft")
    df = read_json_corpus(spark, d)
    return df.select("conv_id", "turn", has_messages(df).alias("has_messages"))


def q_project_only(spark, sf_dir):
    d = _jsonl(spark, fx.instruction_rows(spark, sf_dir), "inst")
    return render(read_json_corpus(spark, d), "chatml", "train", keep=())


def q_drop_text(spark, sf_dir):
    out = tokenize(_docs(spark, sf_dir), "text", 2048, drop_text=True)
    return out.select(*[c for c in out.columns if c not in ("input_ids", "attention_mask")], _n(F.col("input_ids")).alias("n_tokens"))


def q_pass_through(spark, sf_dir):
    d = _jsonl(spark, fx.preference_rows(spark, sf_dir), "pref")
    df = load_preference(spark, d)
    return df.select("conv_id", "prompt", "chosen", "rejected", "split")


def q_append_field(spark, sf_dir):
    rows = fx.open_chat_rows(spark, sf_dir).withColumn(
        "prediction", F.when(F.col("conv_id") % 2 == 0, F.lit("stale"))
    )
    out = generate(rows, first_words_generator, GEN)
    return out.select("conv_id", _n(F.col("messages")).alias("n_msgs"), "prediction")


# ---------------------------------------------------------------- split


def q_eval_source(spark, sf_dir):
    tr = _jsonl(spark, _docs(spark, sf_dir).select("doc_id", "text"), "train")
    ev = _jsonl(spark, fx.table(spark, sf_dir, "benchmark"), "eval")
    df = split_dataset(*read_train_eval(spark, tr, ev), 0.5, key="doc_id")
    return df.select("split", "doc_id", "item_id", F.md5("text").alias("h"))


def q_rate_split(spark, sf_dir):
    return assign_split(_docs(spark, sf_dir), 0.1, key="doc_id", seed=42, unique=True).select("doc_id", "split")


def q_rate_split_by_lang(spark, sf_dir):
    """A key of a few values: rows of the boundary language are told apart by content."""
    docs = _docs(spark, sf_dir).select("lang", "text")
    out = assign_split(docs, 0.1, key="lang", seed=42)
    return out.select("lang", F.md5("text").alias("h"), "split")


def q_split_fallthrough(spark, sf_dir):
    tr = _jsonl(spark, _docs(spark, sf_dir).select("doc_id", "text"), "train")
    train = read_json_corpus(spark, tr)
    missing = fx.fixture_dir(spark, "nothing-here") + "/missing.jsonl"
    ev = expand_spec(spark, missing)
    eval_df = read_json_files(spark, ev.files) if ev else None
    df = split_dataset(train, eval_df, 0.07, key="doc_id")
    return df.select("doc_id", "split")


def q_split_train_only(spark, sf_dir):
    df = split_dataset(_docs(spark, sf_dir), None, 1.5, key="doc_id")
    return df.select("doc_id", "split")


# ---------------------------------------------------------------- rendering


def _inst(spark, sf_dir) -> DataFrame:
    return fx.instruction_rows(spark, sf_dir)


def q_alias_coalesce(spark, sf_dir):
    d = _jsonl(spark, _inst(spark, sf_dir), "inst")
    df = read_json_corpus(spark, d)
    inst, inp, out = _inst_cols(df)
    return df.select("conv_id", "turn", inst.alias("inst"), inp.alias("inp"), out.alias("out"))


def q_render_dispatch(spark, sf_dir):
    d = _jsonl(spark, fx.mixed_sft_rows(spark, sf_dir), "mixed-sft")
    return render(read_json_corpus(spark, d), "alpaca", "train", keep=("conv_id", "turn"))


def q_alpaca_train(spark, sf_dir):
    df = _inst(spark, sf_dir)
    inst, inp, out = _inst_cols(df)
    return df.select("conv_id", "turn", alpaca_text(inst, inp, out).alias("text"))


def q_alpaca_prompt(spark, sf_dir):
    df = _inst(spark, sf_dir)
    inst, inp, _ = _inst_cols(df)
    return df.select("conv_id", "turn", alpaca_text(inst, inp, None).alias("text"))


def q_user_merge(spark, sf_dir):
    df = _inst(spark, sf_dir)
    inst, inp, _ = _inst_cols(df)
    return df.select("conv_id", "turn", user_turn(inst, inp).alias("user"))


def q_to_messages(spark, sf_dir):
    df = _inst(spark, sf_dir)
    inst, inp, out = _inst_cols(df)
    m = instruction_messages(inst, inp, out)
    return df.select(
        "conv_id",
        "turn",
        F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"),
        F.array_join(F.transform(m, lambda x: x["content"]), "|||").alias("contents"),
    )


def q_chat_train(spark, sf_dir):
    df = fx.chat_rows(spark, sf_dir)
    return df.select("conv_id", chat_text(F.col("messages")).alias("text"))


def q_chat_prompt(spark, sf_dir):
    df = fx.chat_rows(spark, sf_dir)
    return df.select("conv_id", chat_text(F.col("messages"), CHATML, add_generation_prompt=True).alias("text"))


def q_plain_train(spark, sf_dir):
    return render(_inst(spark, sf_dir), "chatml", "train", template=None, keep=("conv_id", "turn"))


def q_plain_prompt(spark, sf_dir):
    return render(_inst(spark, sf_dir), "chatml", "prompt", template=None, keep=("conv_id", "turn"))


# ---------------------------------------------------------------- tokens


def q_tokenize(spark, sf_dir):
    ids = _docs(spark, sf_dir).select("doc_id", encode_codepoints(F.col("text")).alias("ids"))
    return ids.select("doc_id", *_ids_cols("ids"))


def q_truncate(spark, sf_dir):
    ids = _docs(spark, sf_dir).select("doc_id", encode_codepoints(F.col("text")).alias("ids"))
    left = truncate(F.col("ids"), 16, "left")
    right = truncate(F.col("ids"), 2048, "right")
    return ids.select(
        "doc_id",
        _n(left).alias("n_left"),
        _digest(left).alias("left_ids"),
        _n(right).alias("n_right"),
        _digest(right).alias("right_ids"),
    )


def q_labels_copy(spark, sf_dir):
    out = tokenize(_docs(spark, sf_dir), "text", 2048, labels=True)
    return out.select(
        "doc_id",
        (F.col("labels") == F.col("input_ids")).alias("same"),
        *_ids_cols("labels"),
        _n(F.filter("attention_mask", lambda x: x == 1)).alias("mask_ones"),
    )


def q_pretrain_tokens(spark, sf_dir):
    d = _jsonl(spark, _docs(spark, sf_dir).select("doc_id", "lang", "text"), "pretrain")
    df, _ = read_pretrain_corpus(spark, d)
    out = tokenize(df, "text", 2048, drop_text=True)
    return out.select("doc_id", "lang", *_ids_cols("input_ids"))


def _mixed_text_oracle_cols(df: DataFrame) -> DataFrame:
    return df.select(F.md5("text").alias("h"), *_ids_cols("input_ids"))


def q_sft_tokens(spark, sf_dir):
    d = _jsonl(spark, fx.mixed_sft_rows(spark, sf_dir), "mixed-sft")
    out = run_job(spark, {"task": "train", "train_data_path": d, "max_seq_len": 2048})
    return _mixed_text_oracle_cols(out)


def q_offline_sft(spark, sf_dir):
    d = _jsonl(spark, _inst(spark, sf_dir), "inst")
    parts = [f.path for f in list_files_recursive(spark, d) if f.name.endswith(".json") and not f.name.startswith((".", "_"))]
    out_dir = fx.fixture_dir(spark, "offline")
    ds = offline_preprocess(spark, ";".join(parts), out_dir, model_max_length=None)
    side = read_sidecar(spark, out_dir)
    return ds.select(
        *_ids_cols("input_ids"),
        (F.col("labels") == F.col("input_ids")).alias("same_labels"),
        (F.size("attention_mask") == F.size("input_ids")).alias("mask_ok"),
        *[F.lit(side[k]).cast("string").alias(k) for k in SIDECAR_FIELDS],
    )


# ---------------------------------------------------------------- preference


def q_pref_load(spark, sf_dir):
    d = _jsonl(spark, fx.preference_rows(spark, sf_dir), "pref")
    df = load_preference(spark, d, rate=0.2, key=["conv_id"])
    return df.select("conv_id", "split")


def q_pref_tokens(spark, sf_dir):
    return _pref_cols(preference_tokens(fx.preference_rows(spark, sf_dir), PreferenceBudget.job_defaults()))


def _pref_cols(out: DataFrame, *more: str) -> DataFrame:
    names = {"p": "prompt_input_ids", "c": "chosen_input_ids", "r": "rejected_input_ids"}
    return out.select("conv_id", *more, *[f(F.col(c)).alias(f"{n}{k}") for k, c in names.items() for n, f in (("n", _n), ("h", _digest))])


def q_pref_budget(spark, sf_dir):
    """Direct defaults (half and half) of a small budget, cut on the left."""
    return _pref_cols(preference_tokens(fx.preference_rows(spark, sf_dir), PreferenceBudget(257), side="left"))


def q_pref_tokens_tight(spark, sf_dir):
    """A prompt budget above the whole one, through a plug-in tokenizer."""
    encoder = encode_with(codepoint_tokenizer)
    return _pref_cols(preference_tokens(fx.preference_rows(spark, sf_dir), PreferenceBudget.job_defaults(256), encoder))


# ---------------------------------------------------------------- generation


def q_generate(spark, sf_dir):
    rows = _inst(spark, sf_dir).drop("output", "response")
    return generate(rows, first_words_generator, GEN).select("conv_id", "turn", "prediction")


def padded_words_generator(config: GenerationConfig):
    """Stand-in model whose output carries outer whitespace."""
    inner = first_words_generator(config)
    return lambda prompts: [f" \n\t{x}\r\n " for x in inner(prompts)]


def q_strip_prediction(spark, sf_dir):
    rows = _inst(spark, sf_dir).drop("output", "response")
    return generate(rows, padded_words_generator, GEN).select("conv_id", "turn", "prediction")


def q_row_passthrough(spark, sf_dir):
    d = _jsonl(spark, _prompt_rows(spark, sf_dir), "prompts")
    out = generate(read_prompt_file(spark, d), first_words_generator, GEN)
    return out.select(
        "conv_id",
        "turn",
        _msg_count().alias("n_msgs"),
        F.coalesce("instruction", "instr").alias("inst"),
        "input",
        "prediction",
    )


def q_output_order(spark, sf_dir):
    src = _prompt_rows(spark, sf_dir).sortWithinPartitions("conv_id", "turn")
    d = _jsonl(spark, src, "prompts-sorted")
    rows = read_json_corpus(spark, d)
    out = generate(rows.withColumn("src_file", F.col("_file_ord")), first_words_generator, GEN)
    dest = fx.fixture_dir(spark, "predictions")
    write_predictions(out, dest)
    back = read_json_corpus(spark, dest).withColumn("key", F.struct("conv_id", "turn"))
    # Each output row is before the next row written from the same source file
    # (next row found in range partitions, so a large output file is not one task).
    nxt = next_in_group(back, ["_file_ord", "src_file"], ["_block_ord", "_row_ord"], ["key"])
    return nxt.select(
        "conv_id",
        "turn",
        "prediction",
        F.coalesce(F.col("key") < F.col("next_key"), F.lit(True)).alias("in_order"),
    )


# ---------------------------------------------------------------- sinks


def q_dataset_sink(spark, sf_dir):
    out = fx.fixture_dir(spark, "dataset")
    write_dataset(chat_training_set(spark, sf_dir), out, partition_by=("split",))
    back = spark.read.parquet(out)
    return back.select("conv_id", "split", "n_tokens", F.md5("text").alias("h"))


def q_prediction_sink(spark, sf_dir):
    rows = _inst(spark, sf_dir).drop("output", "response")
    dest = fx.fixture_dir(spark, "predictions")
    write_predictions(generate(rows, first_words_generator, GEN), dest)
    return spark.read.json(dest).select("conv_id", "turn", "prediction")


def q_prediction_sink_lossless(spark, sf_dir):
    d = _jsonl(spark, _prompt_rows(spark, sf_dir).withColumn("prediction", F.lit("old")), "prompts")
    rows = read_prompt_file(spark, d, lossless=True)
    dest = fx.fixture_dir(spark, "predictions")
    write_predictions(generate(rows, first_words_generator, GEN), dest, lossless=True)
    lines = spark.read.text(dest)
    v = F.col("value")
    return lines.select(
        F.get_json_object(v, "$.conv_id").cast("bigint").alias("conv_id"),
        F.get_json_object(v, "$.turn").cast("bigint").alias("turn"),
        F.get_json_object(v, "$.prediction").alias("prediction"),
        F.array_join(F.json_object_keys(v), ",").alias("keys"),
    )


def q_manifest(spark, sf_dir):
    root = _lang_shards(spark, sf_dir)
    spec = ";".join([f"{root}/lang={x}" for x in LANG_SHARDS] + [f"{root}/lang={LANG_SHARDS[0]}", f"{root}/lang=xx"])
    exp = expand_spec(spark, spec)
    df = read_json_files(spark, exp.files)
    path = fx.fixture_dir(spark, "manifest")
    write_manifest(spark, path, spec, "hf_jsonl", file_row_counts(df), exp.missing)
    head, files = read_manifest(spark, path)
    per_spec = files.groupBy("spec_ord").agg(F.sum("rows").cast("bigint").alias("rows"))
    return per_spec.select(
        "spec_ord",
        "rows",
        F.lit(head["backend"]).alias("backend"),
        F.lit(len(exp.missing)).cast("bigint").alias("n_missing"),
    )


# ---------------------------------------------------------------- UDF surface


def word_counts(b: pd.DataFrame) -> pd.DataFrame:
    n = b["text"].fillna("").str.split(r"[ \t\n\r]+", regex=True).map(lambda ws: sum(1 for w in ws if w))
    return pd.DataFrame({"doc_id": b["doc_id"], "n_words": n.astype("int64")})


def q_batch_map(spark, sf_dir):
    return batch_map(_docs(spark, sf_dir), word_counts, "doc_id bigint, n_words bigint", columns=["doc_id", "text"])


def codepoint_tokenizer():
    """Stand-in plug-in tokenizer (built once per worker): code points."""
    return lambda texts: {"input_ids": [np.frombuffer(t.encode("utf-32-le"), dtype="<u4").astype(np.int32) for t in texts]}


def q_worker_init(spark, sf_dir):
    ids = _docs(spark, sf_dir).select("doc_id", encode_with(codepoint_tokenizer)(F.col("text")).alias("ids"))
    return ids.select("doc_id", *_ids_cols("ids"))


def python_chatml(messages: list[dict], add_generation_prompt: bool) -> str:
    text = "".join(f"<|im_start|>{m['role']}\n{m['content']}<|im_end|>\n" for m in messages)
    return text + ("<|im_start|>assistant\n" if add_generation_prompt else "")


def q_custom_render(spark, sf_dir):
    df = fx.chat_rows(spark, sf_dir)
    text = custom_chat(python_chatml, False)(F.col("messages"), F.lit(None).cast("string"))
    return df.select("conv_id", text.alias("text"))


# ---------------------------------------------------------------- jobs


def q_run_job(spark, sf_dir):
    tr = _jsonl(spark, _inst(spark, sf_dir), "inst")
    dv = _jsonl(spark, fx.chat_rows(spark, sf_dir), "chat")
    work = fx.fixture_dir(spark, "work")
    out = run_job(
        spark,
        {"task": "lora_train", "train_data_path": [tr], "dev_data_path": dv, "dev_split_rate": 0.3, "work_path": work,
         "learning_rate": 1e-4},
    )
    return out.select("split", F.md5("text").alias("h"), _n(F.col("input_ids")).alias("n_tokens"))


def q_run_job_custom(spark, sf_dir):
    """A custom chat renderer, and eval data of another shape than the training data."""
    tr = _jsonl(spark, fx.chat_rows(spark, sf_dir), "chat")
    dv = _jsonl(spark, fx.instruction_rows(spark, sf_dir).withColumn("messages", F.array().cast("array<string>")), "inst")
    out = run_job(spark, {"task": "train", "train_data_path": tr, "dev_data_path": dv}, custom=python_chatml)
    return out.select("split", F.md5("text").alias("h"), *_ids_cols("input_ids"))


def q_mixed_layouts(spark, sf_dir):
    """Chats in one file, and null, empty and ``""`` messages in others of both layouts."""
    chat = _jsonl(spark, fx.chat_rows(spark, sf_dir).withColumn("item_id", F.lit("").cast("string")), "chat")
    bench = fx.table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("instruction"))
    empty = bench.withColumn("messages", F.when(F.col("item_id") % 2 == 0, F.lit("")))
    lines = fx.fixture_dir(spark, "empty-messages")
    empty.select(F.to_json(F.struct("item_id", "instruction", "messages"), {"ignoreNullFields": "false"}).alias("value")).write.text(lines)
    for f in list_files_recursive(spark, lines):
        if f.name.endswith(".txt") and not f.name.startswith("."):
            fx.rename(spark, f.path, f.path[: -len(".txt")] + ".jsonl")
    nulls = bench.withColumn("messages", F.array().cast("array<string>"))
    arrays = _write_array_files(spark, nulls, "item_id", 64, "null-messages")
    dirs = sorted({f.path.rsplit("/", 1)[0] for f in list_files_recursive(spark, arrays) if f.name.endswith(".json")})
    df = read_json_corpus(spark, [chat, lines, *dirs])
    text = render(df, "alpaca", "train", keep=("conv_id", "item_id", "_spec_ord"))
    return text.select("conv_id", F.col("item_id").cast("bigint").alias("item_id"), F.least("_spec_ord", F.lit(2).cast("bigint")).alias("part"), F.md5("text").alias("h"))


def q_nested_empty(spark, sf_dir):
    """``""`` and ``[]`` at any depth, in line files and array files; whole numbers beyond
    64 bits in the latter; every value comes back as its type, the empty ones null."""
    n = F.col("doc_id")
    number = n.cast("string")

    def field(name, *when):
        value = when[-1]
        for every, other in reversed(when[:-1]):
            value = F.when(n % every == 0, other).otherwise(value)
        return F.concat(F.lit(f'"{name}":'), value)

    empty = F.lit('""')
    inner = F.concat(F.lit("{"), field("n", (3, empty), F.length("text").cast("string")), F.lit(","), field("t", (2, empty), F.lit('"x"')), F.lit("}"))
    items = F.concat(F.lit('[{"k":'), number, F.lit("},"), F.when(n % 4 == 0, empty).otherwise(F.concat(F.lit('{"k":'), (n * 2).cast("string"), F.lit("}"))), F.lit(',{"k":""}]'))
    wide = F.when(n % 2 == 0, number).otherwise(F.concat(F.lit("1234567890123456789"), F.lpad(number, 9, "0")))
    row = F.concat(
        F.lit("{"), field("id", number), F.lit(","), field("m", (5, empty), (7, F.lit("[]")), inner), F.lit(","),
        field("l", (6, empty), (11, F.lit("[]")), items), F.lit(","), field("w", wide), F.lit("}"),
    )
    docs = _docs(spark, sf_dir)
    lines, arrays = fx.fixture_dir(spark, "nested-lines"), fx.fixture_dir(spark, "nested-arrays")
    docs.where(n % 2 == 0).select(row.alias("value")).write.text(lines)
    whole = docs.where(n % 2 == 1).groupBy(F.floor(n / 64).alias("bucket")).agg(F.array_join(F.collect_list(row), ",\n").alias("rows"))
    whole.select("bucket", F.concat(F.lit(" [ "), "rows", F.lit(" ]\n")).alias("value")).write.partitionBy("bucket").text(arrays)
    for folder, suffix in ((lines, ".jsonl"), (arrays, ".json")):
        for f in list_files_recursive(spark, folder):
            fx.rename(spark, f.path, f.path[: -len(".txt")] + suffix)
    dirs = sorted({f.path.rsplit("/", 1)[0] for f in list_files_recursive(spark, arrays)})
    df = read_json_corpus(spark, [lines, *dirs])
    return df.select(
        F.col("id").alias("doc_id"),
        F.col("m.n").alias("n"),
        F.col("m.t").alias("t"),
        F.col("m").isNull().alias("no_m"),
        F.when(F.col("l").isNotNull(), F.size("l")).cast("bigint").alias("n_items"),
        F.array_join(F.transform("l", lambda x: F.coalesce(x["k"].cast("string"), F.when(x.isNull(), "gone").otherwise("null"))), ",").alias("items"),
        F.col("w").cast("string").alias("w"),
    )


def q_run_job_dpo(spark, sf_dir):
    tr = _jsonl(spark, fx.preference_rows(spark, sf_dir), "pref")
    schema = "conv_id bigint, prompt string, chosen string, rejected string"
    out = run_job(spark, {"task": "dpo_train", "train_data_path": tr, "max_seq_len": 1024, "schema": schema, "json_layout": "lines"})
    return _pref_cols(out, "split")


def q_run_job_pretrain(spark, sf_dir):
    tr = _jsonl(spark, _docs(spark, sf_dir).select("doc_id", "text"), "pretrain")
    out = run_job(spark, {"task": "pretrain", "train_data_path": tr, "max_seq_len": 512})
    return out.select("doc_id", "split", *_ids_cols("input_ids"))


def q_run_job_test(spark, sf_dir):
    d = _jsonl(spark, _prompt_rows(spark, sf_dir), "prompts")
    dest = fx.fixture_dir(spark, "test-out")
    run_job(
        spark,
        {"task": "test", "test_file": d, "test_output_file": dest, "generate_configs": '{"max_new_tokens": 8}'},
    )
    return spark.read.json(dest).select("conv_id", "turn", "prediction")


# ---------------------------------------------------------------- run logs


def _log_fixture(spark, sf_dir) -> str:
    rows = fx.run_log_rows(spark, sf_dir).select(
        "log_id",
        "event_id",
        (F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col("ts")) / F.lit(1_000_000)).alias("ts"),
        "phase",
        F.when(F.col("phase") == "error", "fail").when(F.col("phase") == "purchase", "success").otherwise("running").alias("status"),
        "isfin",
        "is_total_start",
    )
    root = fx.fixture_dir(spark, "runlogs")
    # a log has one file, or a few where it is long: no log fills one task
    fx.write_by_key(rows, "log_id", "event_id", root, range_partitions(rows))
    return root


def q_log_scan(spark, sf_dir):
    root = _log_fixture(spark, sf_dir)
    dirs = sorted({f.path.rsplit("/", 1)[0] for f in list_files_recursive(spark, root) if f.name.endswith(".json")})
    logs = read_run_logs(spark, ";".join(dirs))
    user = F.regexp_extract(F.col("log_id"), r"log_id=(\d+)", 1).cast("bigint")
    return logs.select(user.alias("user_id"), "event_id", "phase", "status", "isfin", "is_total_start")


def _runs(spark, sf_dir) -> DataFrame:
    return number_runs(fx.run_log_rows(spark, sf_dir), tiebreak=("event_id",))


def q_log_runs(spark, sf_dir):
    r = _runs(spark, sf_dir)
    return r.groupBy("log_id", "run_no").agg(
        F.count("*").cast("bigint").alias("n"), F.sum(F.col("isfin").cast("bigint")).alias("fins")
    )


def q_phase_durations(spark, sf_dir):
    d = phase_durations(_runs(spark, sf_dir), tiebreak=("event_id",))
    return d.select("log_id", "run_no", "phase", "event_id", "state", "micros")


def q_run_outcomes(spark, sf_dir):
    r = _runs(spark, sf_dir).withColumn(
        "status",
        F.when(F.col("phase") == "error", "fail").when(F.col("phase") == "purchase", "success").otherwise("running"),
    )
    return run_outcomes(r)


QUERIES = {
    "flagship": q_flagship,
    "jsonl_scan": q_jsonl_scan,
    "json_dataset": q_json_dataset,
    "mixture": q_mixture,
    "whole_text": q_whole_text,
    "prompt_file": q_prompt_file,
    "union_chunks": q_union_chunks,
    "has_messages": q_has_messages,
    "project_only": q_project_only,
    "drop_text": q_drop_text,
    "pass_through": q_pass_through,
    "append_field": q_append_field,
    "eval_source": q_eval_source,
    "rate_split": q_rate_split,
    "rate_split_by_lang": q_rate_split_by_lang,
    "split_fallthrough": q_split_fallthrough,
    "split_train_only": q_split_train_only,
    "alias_coalesce": q_alias_coalesce,
    "render_dispatch": q_render_dispatch,
    "alpaca_train": q_alpaca_train,
    "alpaca_prompt": q_alpaca_prompt,
    "user_merge": q_user_merge,
    "to_messages": q_to_messages,
    "chat_train": q_chat_train,
    "chat_prompt": q_chat_prompt,
    "plain_train": q_plain_train,
    "plain_prompt": q_plain_prompt,
    "tokenize": q_tokenize,
    "truncate": q_truncate,
    "labels_copy": q_labels_copy,
    "pretrain_tokens": q_pretrain_tokens,
    "sft_tokens": q_sft_tokens,
    "offline_sft": q_offline_sft,
    "pref_load": q_pref_load,
    "pref_tokens": q_pref_tokens,
    "pref_budget": q_pref_budget,
    "pref_tokens_tight": q_pref_tokens_tight,
    "generate": q_generate,
    "strip_prediction": q_strip_prediction,
    "row_passthrough": q_row_passthrough,
    "output_order": q_output_order,
    "dataset_sink": q_dataset_sink,
    "prediction_sink": q_prediction_sink,
    "prediction_sink_lossless": q_prediction_sink_lossless,
    "manifest": q_manifest,
    "batch_map": q_batch_map,
    "worker_init": q_worker_init,
    "custom_render": q_custom_render,
    "run_job": q_run_job,
    "run_job_custom": q_run_job_custom,
    "mixed_layouts": q_mixed_layouts,
    "nested_empty": q_nested_empty,
    "run_job_dpo": q_run_job_dpo,
    "run_job_pretrain": q_run_job_pretrain,
    "run_job_test": q_run_job_test,
    "log_scan": q_log_scan,
    "log_runs": q_log_runs,
    "phase_durations": q_phase_durations,
    "run_outcomes": q_run_outcomes,
}

