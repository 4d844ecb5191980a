"""Flagship: conversations -> ChatML -> code points -> truncate -> labels -> split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.tokens import encode_truncated
from corpusmill.operators.conversations import render_turns
from corpusmill.operators.split import split_label
from corpusmill.plans.fixtures import table


def chat_training_set(
    spark: SparkSession, sf_dir: str, max_len: int = 2048, rate: float = 0.1, seed: int = 42
) -> DataFrame:
    """``conv_id, split, n_tokens, text`` per conversation."""
    turns = table(spark, sf_dir, "conversations")
    ids = encode_truncated(F.col("text"), max_len)
    prepared = render_turns(turns).select("conv_id", "text", ids.alias("input_ids")).withColumn("labels", F.col("input_ids"))
    # the split looks at the ids of the conversations only, and labels them by a projection
    label = split_label(turns.select("conv_id").distinct(), rate, key="conv_id", seed=seed)
    return prepared.select("conv_id", label.alias("split"), F.size("input_ids").cast("bigint").alias("n_tokens"), "text")
