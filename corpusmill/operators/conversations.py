"""Conversations stored one turn per row, assembled per conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.prompts import CHATML, ChatTemplate

TURN_BLOCK = 64  # turns per first-level group


def _ordered_concat(order: Column, piece: Column) -> Column:
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), piece.alias("p")))), lambda x: x["p"]),
        "",
    )


def render_turns(
    turns: DataFrame,
    conv: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    content: str = "text",
    template: ChatTemplate = CHATML,
    add_generation_prompt: bool = False,
    block: int = TURN_BLOCK,
) -> DataFrame:
    """Chat text per conversation, equal to rendering its sorted message list.

    Each turn is rendered where it is read (before any shuffle), then joined in
    two ordered levels: runs of ``block`` consecutive turns first, then the runs
    of one conversation. A conversation with millions of turns is thereby
    spread over many tasks in the first level and arrives at the second as a
    few thousand pre-joined pieces instead of millions of rows."""
    piece = F.concat(
        F.lit(template.prefix),
        F.coalesce(F.col(role), F.lit("")),
        F.lit(template.role_sep),
        F.coalesce(F.col(content), F.lit("")),
        F.lit(template.suffix),
    )
    first = (
        turns.select(F.col(conv), F.col(order).alias("_o"), F.col(role).alias("_r"), piece.alias("_piece"))
        .groupBy(conv, F.floor(F.col("_o") / F.lit(block)).alias("_blk"))
        .agg(
            _ordered_concat(F.col("_o"), F.col("_piece")).alias("_chunk"),
            F.min(F.struct("_o", "_r")).alias("_first"),
            F.count("*").alias("_n"),
        )
    )
    text = _ordered_concat(F.col("_blk"), F.col("_chunk"))
    if template.default_system is not None:
        system = f"{template.prefix}system{template.role_sep}{template.default_system}{template.suffix}"
        opened = F.coalesce(F.min("_first")["_r"], F.lit("")) == "system"
        text = F.concat(F.when(opened, F.lit("")).otherwise(F.lit(system)), text)
    if add_generation_prompt:
        text = F.concat(text, F.lit(template.generation_prompt()))
    return first.groupBy(conv).agg(text.alias("text"), F.sum("_n").alias("n_turns"))


def conversation_messages(
    turns: DataFrame,
    conv: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    content: str = "text",
    block: int = TURN_BLOCK,
) -> DataFrame:
    """``messages: array<struct<content, role>>`` per conversation, sorted by
    turn (the chat row shape a JSON reader infers). Built in the same two
    ordered levels as ``render_turns``: sorted runs of ``block`` turns, then
    the runs of one conversation concatenated in order."""
    msg = F.struct(F.col(order).alias("o"), F.col(content).alias("content"), F.col(role).alias("role"))
    first = turns.groupBy(conv, F.floor(F.col(order) / F.lit(block)).alias("_blk")).agg(
        F.transform(F.array_sort(F.collect_list(msg)), lambda x: F.struct(x["content"], x["role"])).alias("_run")
    )
    runs = F.array_sort(F.collect_list(F.struct(F.col("_blk").alias("b"), F.col("_run").alias("r"))))
    return first.groupBy(conv).agg(F.flatten(F.transform(runs, lambda x: x["r"])).alias("messages"))
