"""Sinks: prepared datasets, sidecar metadata, predictions, job manifests.

All writes go through Spark's output committer (task retries and lost
executors leave no partial files)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.generate import drop_positions, in_input_order, lossless_lines
from corpusmill.sources.files import exists
from corpusmill.sources.paths import SpecFile

META_NAME = "_meta"  # Spark readers skip '_' names, so metadata sits beside the data
SIDECAR_FIELDS = ("task", "tokenizer", "model_type", "prompt_type", "truncation_side")


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    """Prepared table as Parquet (the directory is created or replaced)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def _one_row(spark: SparkSession, obj: dict) -> DataFrame:
    fields = [T.StructField(k, T.StringType(), True) for k in obj]
    vals = tuple(None if v is None else (v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)) for v in obj.values())
    return spark.createDataFrame([vals], T.StructType(fields))


def write_sidecar(spark: SparkSession, path: str, meta: dict) -> str:
    """One-row JSON with the preprocessing settings (nulls kept)."""
    row = {k: meta.get(k) for k in SIDECAR_FIELDS}
    out = f"{path.rstrip('/')}/{META_NAME}"
    _one_row(spark, row).coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(out)
    return out


def read_sidecar(spark: SparkSession, path: str) -> dict:
    rows = spark.read.json(f"{path.rstrip('/')}/{META_NAME}").collect()
    return rows[0].asDict() if rows else {}


def write_predictions(df: DataFrame, path: str, lossless: bool = False) -> str:
    """UTF-8 JSON Lines, non-ASCII kept literally, one object per input row,
    rows of each file in input order. ``lossless`` re-emits the source line."""
    if lossless:
        lossless_lines(df).write.mode("overwrite").text(path)
    else:
        drop_positions(in_input_order(df)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def file_row_counts(df: DataFrame) -> DataFrame:
    """Rows per source file (one row per file: bounded by the file list;
    partially aggregated before the shuffle)."""
    if "_path" not in df.columns:  # whole-text chunks carry no path column
        df = df.withColumn("_path", F.lit(None).cast("string"))
    return df.groupBy("_file_ord", "_spec_ord", "_path").agg(F.count("*").cast("bigint").alias("rows"))


def known_row_counts(spark: SparkSession, files: Sequence[SpecFile], rows: dict[str, int], texts: Sequence[SpecFile] = ()) -> DataFrame:
    """As ``file_row_counts``, from counts that a pass over the files has left (by URI):
    ``files`` in reading order, then text files of one row each. The table is as long as
    the file list, which the driver holds."""
    out = [(k, f.spec_ord, f.uri, rows[f.uri]) for k, f in enumerate(files) if rows.get(f.uri)]
    out += [(len(files) + k, f.spec_ord, None, 1) for k, f in enumerate(texts)]
    return spark.createDataFrame(out, "_file_ord bigint, _spec_ord bigint, _path string, rows bigint")


def write_manifest(
    spark: SparkSession,
    path: str,
    train_data_path: str,
    backend: str,
    counts: DataFrame | None = None,
    missing: Sequence[str] = (),
    options: dict | None = None,
) -> str:
    """``{train_data_path, backend, missing, options}`` as a one-row JSON
    under ``path`` (``options``: the job's trainer settings, carried unread);
    with ``counts``, one JSON line per source file with its row count under
    ``path/_files`` (written by the tasks, never gathered)."""
    head = _one_row(
        spark,
        {"train_data_path": train_data_path, "backend": backend, "missing": list(missing), "options": options or {}},
    )
    head.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    if counts is not None:
        counts.select(
            F.col("_file_ord").alias("file_ord"), F.col("_spec_ord").alias("spec_ord"), F.col("_path").alias("path"), "rows"
        ).write.mode(
            "overwrite"
        ).json(f"{path.rstrip('/')}/_files")
    return path


def read_manifest(spark: SparkSession, path: str) -> tuple[dict, DataFrame | None]:
    head = spark.read.json(path).collect()[0].asDict()
    counts = f"{path.rstrip('/')}/_files"
    if not exists(spark, counts):  # no per-file counts were written
        return head, None
    return head, spark.read.schema("file_ord bigint, spec_ord bigint, path string, rows bigint").json(counts)
