"""Reference-shaped inputs derived from the generated tables.

Every fixture is a Spark job over the whole table; nothing is sampled. The
derivations follow FIXTURES.md so that DuckDB can rebuild each one in SQL.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.conversations import conversation_messages
from corpusmill.operators.ordered import next_in_group
from corpusmill.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def chat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SFT chat rows: ``conv_id, messages`` (turns sorted, text as content)."""
    return conversation_messages(table(spark, sf_dir, "conversations"))


def instruction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SFT instruction rows: a user turn answered by the next assistant turn;
    aliases alternate by ``conv_id`` and ``turn`` so both names occur.

    The next turn comes from ``next_in_group`` (range partitions, so a very long
    conversation is not sorted in one task); the system text is one
    partially aggregated row per conversation, joined back on ``conv_id``."""
    c = table(spark, sf_dir, "conversations")
    p = next_in_group(c.select("conv_id", "turn", "role", "text"), ["conv_id"], ["turn"], ["text", "role"])
    sys = c.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "system", F.col("text"))).alias("sys"))
    p = p.where((F.col("role") == "user") & (F.col("next_role") == "assistant")).join(sys, "conv_id", "left")
    return p.select(
        "conv_id",
        "turn",
        F.when(F.col("conv_id") % 2 == 0, F.col("text")).alias("instruction"),
        F.when(F.col("conv_id") % 2 == 1, F.col("text")).alias("instr"),
        F.coalesce(F.col("sys"), F.lit("")).alias("input"),
        F.when(F.col("turn") % 4 < 2, F.col("next_text")).alias("output"),
        F.when(F.col("turn") % 4 >= 2, F.col("next_text")).alias("response"),
    )


def preference_rows(spark: SparkSession, sf_dir: str, complete_only: bool = True) -> DataFrame:
    """``conv_id, prompt, chosen, rejected``: first user turn, first and last
    assistant turns (one hash aggregate with partial aggregation, no window)."""
    c = table(spark, sf_dir, "conversations")
    d = c.groupBy("conv_id").agg(
        F.expr("min_by(text, turn) FILTER (WHERE role = 'user')").alias("prompt"),
        F.expr("min_by(text, turn) FILTER (WHERE role = 'assistant')").alias("chosen"),
        F.expr("max_by(text, turn) FILTER (WHERE role = 'assistant')").alias("rejected"),
    )
    if complete_only:
        d = d.where(F.col("prompt").isNotNull() & F.col("chosen").isNotNull() & F.col("rejected").isNotNull())
    return d


def open_chat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt rows: conversations whose last turn is an unanswered user turn."""
    c = table(spark, sf_dir, "conversations")
    last = c.groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"))
    msgs = conversation_messages(c)
    return msgs.join(last.where(F.col("last_role") == "user").select("conv_id"), "conv_id", "left_semi")


def mixed_sft_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat rows and instruction rows in one table, as one JSONL file mixes
    them: instruction rows carry ``messages`` null or ``[]`` (by ``turn``)."""
    chat = chat_rows(spark, sf_dir).withColumn("turn", F.lit(-1).cast("bigint"))
    inst = instruction_rows(spark, sf_dir)
    msg_type = "array<struct<content:string,role:string>>"
    inst = inst.withColumn(
        "messages",
        F.when(F.col("turn") % 2 == 0, F.lit(None).cast(msg_type)).otherwise(F.array().cast(msg_type)),
    )
    return chat.unionByName(inst, allowMissingColumns=True)


def run_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in run log from ``events`` (full of unpaired events on purpose)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("log_id"),
        "event_id",
        "ts",
        F.col("event_type").alias("phase"),
        (F.col("event_id") % 2 == 1).alias("isfin"),
        (F.col("event_id") % 7 == 0).alias("is_total_start"),
    )


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Gives a written file another suffix (fixtures only: Spark itself renames nothing)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(src)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(path, jvm.org.apache.hadoop.fs.Path(dst)):
        raise OSError(f"could not rename {src} to {dst}")


def write_by_key(df: DataFrame, key: str, order: str, path: str, partitions: int) -> None:
    """JSON lines in a folder ``key=value`` for each value of a whole-number ``key``: one
    file, or a few where it has many rows (range partitions by ``key`` and ``order``).

    In a local or mounted folder the tasks write the files themselves: for every folder,
    file and checksum file there, Hadoop starts a ``chmod`` process, which takes far longer
    than writing a short log. A file gets its name when it is whole, and every try of a task
    gives the same files."""
    spark = df.sparkSession
    placed = df.repartitionByRange(partitions, key, order)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getScheme() != "file":
        placed.write.partitionBy(key).json(path)
        return
    fs.mkdirs(root)
    top = fs.makeQualified(root).toUri().getPath()
    value = F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    line = F.concat(F.to_json(F.struct(*[c for c in df.columns if c != key])), F.lit("\n"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}.json"
        unfinished = f".{name}.{task.taskAttemptId()}"  # readers pass over it
        at, out, files = None, None, 0

        def finish() -> None:
            out.close()
            os.replace(f"{at}/{unfinished}", f"{at}/{name}")

        for batch in batches:
            runs = pc.run_end_encode(batch.column(0))
            lines = batch.column(1).cast(pa.large_binary())
            _, offsets, data = lines.buffers()
            starts = np.frombuffer(offsets, np.int64)[lines.offset :]
            begin = 0
            for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if at != f"{top}/{key}={value}":
                    if out is not None:
                        finish()
                    at, files = f"{top}/{key}={value}", files + 1
                    os.makedirs(at, exist_ok=True)
                    out = open(f"{at}/{unfinished}", "wb")
                out.write(memoryview(data)[starts[begin] : starts[end]])
                begin = end
        if out is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    placed.sortWithinPartitions(key, order).select(value, line).mapInArrow(write, "files long").agg(F.sum("files")).collect()


def write_jsonl(df: DataFrame, path: str) -> str:
    """Write JSON Lines (absent/null fields omitted, like hand-written rows)."""
    df.write.mode("overwrite").json(path)
    return path


def fixture_dir(spark: SparkSession, label: str) -> str:
    return scratch_dir(spark, label)
