"""The corpus pipeline: documents in, tokens out.

``STAGES`` names each stage and its function ``(spark, docs, sf_dir) ->
DataFrame``. Each stage's result is written as Parquet and read again as the
next one's ``docs``, so an executor lost later never repeats an earlier stage.
Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import bpe, exact, langid, partenum, winnow
from corpusmill.session import scratch_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language. The model is fitted on the labelled
    documents of this stage's own input; ``und`` goes."""
    return langid.keep_known(docs, langid.train(docs.filter(~langid.held_out())))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text, the one with the largest id."""
    return exact.drop_exact(docs, keep="largest")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (word 5-grams, similarity 0.75) the
    document with the smallest id."""
    return partenum.drop_similar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return winnow.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_decode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: The stages fit a model and enumerate signatures, which SQL cannot express; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = scratch_dir(spark, f"pipeline-{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
