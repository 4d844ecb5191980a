"""Batch generation: render each row's prompt natively, run a user generator
on Arrow batches, append ``prediction``.

Only the prompt column crosses into Python (an iterator ``pandas_udf``); every
other column stays in the JVM, so the UDF is not a barrier for them. The
generator is built once per Python worker and reused for all its batches.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions.prompts import CHATML, ChatTemplate, render_column
from corpusmill.functions.udf import resource_key, worker_resource
from corpusmill.sources.json_corpus import META_COLS, order_cols

_FALSE = {"false", "0", "no", "off", ""}


def _flag(v) -> bool:
    if isinstance(v, str):
        return v.strip().lower() not in _FALSE
    return bool(v)


@dataclass(frozen=True)
class GenerationConfig:
    max_new_tokens: int = 256
    temperature: float = 0.7
    top_p: float = 0.9
    do_sample: bool = True

    @classmethod
    def parse(cls, cfg: dict | str | None) -> GenerationConfig:
        """Dict or JSON text; missing is ``{}``; malformed text raises."""
        if not cfg:
            cfg = {}
        if isinstance(cfg, str):
            cfg = json.loads(cfg)
        if not isinstance(cfg, dict):
            raise ValueError("generate config must be a JSON object")
        return cls(
            max_new_tokens=int(cfg.get("max_new_tokens", 256)),
            temperature=float(cfg.get("temperature", 0.7)),
            top_p=float(cfg.get("top_p", 0.9)),
            do_sample=_flag(cfg.get("do_sample", True)),
        )

    def to_dict(self) -> dict:
        return asdict(self)


_WS = re.compile(r"[ \t\n\r]+")


def first_words_generator(config: GenerationConfig) -> Callable[[list[str]], list[str]]:
    """Deterministic stand-in model: the first ``max_new_tokens`` words of the
    prompt (split on ASCII whitespace), joined by one space."""
    n = config.max_new_tokens

    def gen(prompts: list[str]) -> list[str]:
        return [" ".join([w for w in _WS.split(p) if w][:n]) for p in prompts]

    return gen


def prediction_udf(factory, config: GenerationConfig, batch_size: int = 32):
    key = resource_key((factory, config))

    @F.pandas_udf(T.StringType())
    def _predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        gen = worker_resource(lambda: factory(config), key)
        for s in batches:
            prompts = s.fillna("").tolist()
            out: list[str] = []
            for i in range(0, len(prompts), batch_size):
                chunk = prompts[i : i + batch_size]
                res = list(gen(chunk))
                if len(res) != len(chunk):
                    raise ValueError(f"generator returned {len(res)} outputs for {len(chunk)} prompts")
                out.extend("" if r is None else str(r).strip() for r in res)
            yield pd.Series(out, dtype=object)

    # a sampling model gives another text each time: Spark must neither run it
    # twice nor push a filter on its output below it
    return _predict.asNondeterministic()


def generate(
    df: DataFrame,
    factory: Callable[[GenerationConfig], Callable[[list[str]], list[str]]] = first_words_generator,
    config: GenerationConfig | dict | str | None = None,
    prompt_type: str = "chatml",
    template: ChatTemplate | None = CHATML,
    custom=None,
    column: str = "prediction",
    keep_prompt: bool = False,
    batch_size: int = 32,
    partitions: int | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Every input column survives; ``prediction`` is appended, or overwritten
    in place when the row already has one. Prompts are not truncated.

    The model runs in the tasks of the scan unless told otherwise. Prompts are
    small rows whose cost is the model, so ``rows_per_task`` cuts them into as many
    tasks as that takes (their number is counted first), and ``partitions`` into a
    fixed number. Rows read through ``corpusmill.sources`` are range-partitioned by
    their source position: task ``i`` holds the ``i``-th stretch of the input, so
    the output files, in name order, are the input order (the range sample reads
    the prompt rows, never the model's output). Other rows are dealt round-robin."""
    cfg = config if isinstance(config, GenerationConfig) else GenerationConfig.parse(config)
    if rows_per_task and not partitions:
        partitions = max(1, -(-df.count() // int(rows_per_task)))
    if partitions:
        oc = order_cols(df)
        df = df.repartitionByRange(int(partitions), *oc) if oc else df.repartition(int(partitions))
    base, prompt = render_column(df, prompt_type, "prompt", template, custom)
    with_prompt = base.withColumn("_prompt", prompt)
    pred = prediction_udf(factory, cfg, batch_size)(F.col("_prompt"))
    cols = [F.col(c) if c != column else pred.alias(column) for c in df.columns]
    if column not in df.columns:
        cols.append(pred.alias(column))
    if keep_prompt:
        cols.append(F.col("_prompt").alias("prompt_text"))
    return with_prompt.select(*cols)


def in_input_order(df: DataFrame) -> DataFrame:
    """Rows of each partition sorted by their source position (no shuffle)."""
    oc = order_cols(df)
    return df.sortWithinPartitions(*oc) if oc else df


@F.pandas_udf(T.StringType())
def merge_prediction_line(raw: pd.Series, pred: pd.Series) -> pd.Series:
    """Source line with ``prediction`` set: original keys, order and nulls
    kept, an existing ``prediction`` overwritten in place."""
    out = []
    for line, p in zip(raw, pred):
        row = json.loads(line)
        row["prediction"] = p
        out.append(json.dumps(row, ensure_ascii=False))
    return pd.Series(out, dtype=object)


def lossless_lines(df: DataFrame, column: str = "prediction") -> DataFrame:
    """``value`` per row for a text sink, in source order within partitions."""
    return in_input_order(df).select(merge_prediction_line(F.col("_raw"), F.col(column)).alias("value"))


def drop_positions(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in META_COLS + ("_raw",) if c in df.columns])
