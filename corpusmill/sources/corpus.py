"""Mixed corpora: JSON chunk and one chunk per text file, concatenated."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from corpusmill.functions.schema import require_columns
from corpusmill.sources.json_corpus import read_sides
from corpusmill.sources.paths import expand_spec, require_files, route_by_suffix
from corpusmill.sources.text_corpus import read_text_files


def union_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """Bag union aligned by column name; a column missing from a chunk is null.
    A single chunk passes through unchanged."""
    if not chunks:
        raise ValueError("nothing to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)


def read_pretrain_corpus(
    spark: SparkSession,
    spec: str | Sequence[str],
    eval_spec: str | Sequence[str] | None = None,
    *,
    what: str = "pretrain",
    json_kw: dict | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Pre-training text, and held-out text if ``eval_spec`` names files:
    ``.json``/``.jsonl`` files (one chunk, needs ``text``) followed by one row per
    ``.txt`` file; other suffixes are dropped. JSON columns have the same type on
    both sides."""
    files = [require_files(expand_spec(spark, spec), what).files]
    files.append(expand_spec(spark, eval_spec).files if eval_spec else [])
    routed = [route_by_suffix(f)[:2] for f in files]
    for f, (js, tx) in zip(files, routed):
        if f and not js and not tx:
            raise ValueError(f"{what}: none of the files is .json, .jsonl or .txt")
    chunks = read_sides(spark, [js for js, _ in routed], **(json_kw or {}))
    out = []
    for (js, tx), chunk in zip(routed, chunks):
        parts = [] if chunk is None else [chunk]
        if tx:
            parts.append(read_text_files(spark, tx, ords=[len(js) + i for i in range(len(tx))]))
        if parts:
            out.append(require_columns(union_chunks(parts), "text", what=f"{what} JSON"))
        else:
            out.append(None)
    return tuple(out)
