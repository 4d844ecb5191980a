"""Preference triples: load, gate, and token arrays under length budgets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.schema import require_columns
from corpusmill.functions.tokens import encode_truncated, truncate
from corpusmill.operators.split import split_dataset
from corpusmill.sources.json_corpus import read_train_eval

PREFERENCE_COLUMNS = ("prompt", "chosen", "rejected")


@dataclass(frozen=True)
class PreferenceBudget:
    """``max_prompt`` defaults to ``max_len // 2`` and ``max_target`` to
    ``max_len - max_prompt`` when used directly; jobs pass 512 / 1536."""

    max_len: int = 2048
    max_prompt: int | None = None
    max_target: int | None = None

    def resolved(self) -> tuple[int, int, int]:
        mp = self.max_prompt if self.max_prompt is not None else self.max_len // 2
        mt = self.max_target if self.max_target is not None else self.max_len - mp
        return int(self.max_len), int(mp), int(mt)

    @classmethod
    def job_defaults(cls, max_seq_len: int = 2048, max_prompt_length: int = 512, max_target_length: int = 1536):
        return cls(max_seq_len, max_prompt_length, max_target_length)


def require_preference(df: DataFrame) -> DataFrame:
    return require_columns(df, *PREFERENCE_COLUMNS, what="DPO dataset")


def load_preference(
    spark: SparkSession,
    train_spec: str | Sequence[str],
    eval_spec: str | Sequence[str] | None = None,
    rate: float | str = 0.0,
    seed: int = 42,
    key: Sequence[str] | None = None,
    schema: str | None = None,
    layout: str = "auto",
    counts: dict | None = None,
) -> DataFrame:
    """Train (and eval) triples with a ``split`` column; all columns pass
    through untouched, no prompt formatting is applied. Both sides are read with
    one schema (``schema``, or the one inferred over both) and gated."""
    train, eval_df = read_train_eval(spark, train_spec, eval_spec, schema=schema, layout=layout, counts=counts, what="DPO training")
    require_preference(train)
    if eval_df is not None:
        require_preference(eval_df)
    return split_dataset(train, eval_df, rate, key=key, seed=seed, materialize_keys=True)


def preference_tokens(
    df: DataFrame,
    budget: PreferenceBudget = PreferenceBudget(),
    encoder: Callable[[Column], Column] | None = None,
    side: str = "right",
) -> DataFrame:
    """``prompt_input_ids`` cut to ``max_prompt``, and to ``max_len`` if that is
    less; each answer cut to ``max_target`` and to what the prompt leaves of
    ``max_len``, so a prompt and an answer never exceed ``max_len``."""
    max_len, max_prompt, max_target = budget.resolved()

    def cut(name: str, n) -> Column:
        if encoder is None:
            return encode_truncated(F.col(name), n, side)
        return truncate(encoder(F.col(name)), n, side)

    out = df.withColumn("prompt_input_ids", cut("prompt", min(max_prompt, max_len)))
    room = F.greatest(F.lit(0), F.least(F.lit(max_target), F.lit(max_len) - F.size("prompt_input_ids")))
    return out.withColumns({"chosen_input_ids": cut("chosen", room), "rejected_input_ids": cut("rejected", room)})
