"""Chat formatting after collapsing cumulative snapshots.

A logged conversation that is a prefix of a longer one is a snapshot of it. Every
turn has a prefix hash: the exclusive or of the hashes of (position, role, text)
of the turns so far, 128 bits, which rolls on from turn to turn and can be put
together from blocks of turns. A conversation goes if its whole hash and length
are the prefix hash of a longer one (an anti-join), or the whole of one with a
smaller id. The conversations that stay are rendered.

Turns are numbered and hashed in blocks of ``BLOCK`` turn numbers, then over the
blocks of a conversation (a row each), and rendered the same way, so a
conversation with very many turns is spread over tasks until its final row. Only
hashes are shuffled until the snapshots are gone. No Python runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import materialize

BLOCK = 64
START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), F.coalesce(role, F.lit("")), F.lit(MIDDLE), F.coalesce(text, F.lit("")), F.lit(END))


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each conversation: its id, ``n_turns``, ``kept``, and ``chat``, the
    rendered turns (null for a conversation that went).

    Turns are ordered by number, then role, then text (nulls first); a null role
    or text renders as empty but is not equal to an empty one. Repeated rows are
    turns of their own. Rows with a null id are one conversation. Of equal
    conversations the one with the smallest id stays. An empty table gives an
    empty result; other columns are not looked at. The prefix hashes are computed
    when this is called and written to the shared checkpoint folder."""
    rows = turns.select(*[F.col(c).alias(n) for c, n in ((conv_id, "_id"), (turn, "_turn"), (role, "_role"), (text, "_text"))])
    key = F.concat(F.when(F.col("_id").isNull(), F.lit("n")).otherwise(F.lit("v")), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    rows = rows.withColumn("_k", key).withColumn("_block", F.coalesce(F.floor(F.col("_turn") / BLOCK), F.lit(-(1 << 60))))
    said = rows.select(
        "_k", "_id", "_block", "_turn", "_role",
        F.xxhash64(F.lit("a"), F.col("_role").isNull(), "_role", F.col("_text").isNull(), "_text").alias("t1"),
        F.xxhash64(F.lit("b"), F.col("_role").isNull(), "_role", F.col("_text").isNull(), "_text").alias("t2"),
    )
    before = Window.partitionBy("_k").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = said.groupBy("_k", "_block").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.select("_k", "_block", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("_k", "_block").orderBy("_turn", "_role", "t1", "t2")
    said = said.withColumn("r", F.row_number().over(within)).join(counts, ["_k", "_block"])
    said = said.withColumn("pos", F.col("offset") + F.col("r"))
    said = said.select("_k", "_id", "_block", "pos", F.xxhash64(F.lit(1), "pos", "t1", "t2").alias("h1"), F.xxhash64(F.lit(2), "pos", "t1", "t2").alias("h2"))
    said = materialize(said, "chat-turns")
    blocks = said.groupBy("_k", "_block").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    blocks = blocks.select("_k", "_block", *[F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"o{i}") for i in (1, 2)])
    upto = Window.partitionBy("_k", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = said.select("_k", "_block", "pos", *[F.bit_xor(f"h{i}").over(upto).alias(f"p{i}") for i in (1, 2)]).join(blocks, ["_k", "_block"])
    prefixes = prefixes.select("_k", "pos", *[F.col(f"p{i}").bitwiseXOR(F.col(f"o{i}")).alias(f"p{i}") for i in (1, 2)])
    whole = said.groupBy("_k").agg(F.first("_id").alias("_id"), F.max("pos").alias("n"), F.bit_xor("h1").alias("w1"), F.bit_xor("h2").alias("w2"))
    whole = materialize(whole, "chat-wholes")
    inner = prefixes.join(whole.select("_k", "n"), "_k").filter("pos < n").select("pos", "p1", "p2").distinct()
    equal = whole.groupBy("n", "w1", "w2").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_k")).alias("best"))
    stay = equal.join(inner, (F.col("n") == F.col("pos")) & (F.col("w1") == F.col("p1")) & (F.col("w2") == F.col("p2")), "left_anti")
    stay = materialize(stay.select(F.col("best._k").alias("_k")), "chat-kept")
    turn_text = F.struct("_turn", "_role", F.xxhash64(F.lit("a"), F.col("_role").isNull(), "_role", F.col("_text").isNull(), "_text").alias("t1"), F.xxhash64(F.lit("b"), F.col("_role").isNull(), "_role", F.col("_text").isNull(), "_text").alias("t2"), render_turn(F.col("_role"), F.col("_text")).alias("said"))
    block_text = rows.join(stay, "_k", "left_semi").groupBy("_k", "_block").agg(F.sort_array(F.collect_list(turn_text)).alias("s"))
    block_text = block_text.select("_k", "_block", F.array_join(F.col("s.said"), "").alias("said"))
    chat = block_text.groupBy("_k").agg(F.sort_array(F.collect_list(F.struct("_block", "said"))).alias("s")).select("_k", F.array_join(F.col("s.said"), "").alias("chat"))
    return whole.join(chat, "_k", "left").select(F.col("_id").alias(conv_id), F.col("n").alias("n_turns"), F.col("chat").isNotNull().alias("kept"), "chat")
