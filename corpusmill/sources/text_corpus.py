"""Whole text files: each file becomes one row ``{"text": ...}``.

Bytes that are not valid UTF-8 are dropped (not replaced by U+FFFD) and line
ends are translated as a text-mode read does (``\\r\\n`` and ``\\r`` become
``\\n``). Spark's ``text(wholetext=True)`` replaces bad bytes instead, so the
bytes are read with ``binaryFile``: valid text is taken as it is in the JVM, and
only content that is not valid goes to a small Arrow-batched helper.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.sources.files import escape_glob
from corpusmill.sources.json_corpus import listed_in_chunks, path_positions
from corpusmill.sources.paths import SpecFile


LONGEST = (1 << 31) - 1  # bytes of a file, which is one value


@F.pandas_udf(T.StringType())
def decode_utf8_ignore(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def decode_text(content):
    text = content.cast("string")
    valid = F.is_valid_utf8(text)
    return F.when(valid, text).otherwise(decode_utf8_ignore(F.when(~valid, content)))


def universal_newlines(col):
    return F.regexp_replace(col, "\r\n?", "\n")


def read_text_files(
    spark: SparkSession,
    files: Sequence[SpecFile],
    *,
    ords: Sequence[int] | None = None,
    with_path: bool = False,
) -> DataFrame:
    if not files:
        raise FileNotFoundError("no text files to read")
    if over := [f for f in files if f.length > LONGEST]:
        raise ValueError(f"{over[0].path}: {over[0].length} bytes are more than one row holds ({LONGEST}); split the file ({len(over)} such)")
    if ords is None:
        ords = list(range(len(files)))
    parts = []
    for chunk in listed_in_chunks(list(zip(ords, files))):
        raw = spark.read.format("binaryFile").load(list(dict.fromkeys(escape_glob(f.path) for _, f in chunk)))
        scanned = raw.select(
            universal_newlines(decode_text(F.col("content"))).alias("text"),
            F.col("_metadata.file_path").alias("_path"),
        )
        cols = [
            "text",
            "_file_ord",
            "_spec_ord",
            F.lit(0).cast("bigint").alias("_block_ord"),
            F.lit(0).cast("bigint").alias("_row_ord"),
        ]
        if with_path:
            cols.append("_path")
        parts.append(path_positions(spark, scanned, chunk).select(*cols))
        # Spark's file scan skips zero-length files; each is still one
        # row with empty text (sizes are known from the listing).
        empty = [(o, f) for o, f in chunk if f.length == 0]
        if empty:
            rows = [("", int(o), int(f.spec_ord), 0, 0) + ((f.uri,) if with_path else ()) for o, f in empty]
            schema = "text string, _file_ord bigint, _spec_ord bigint, _block_ord bigint, _row_ord bigint"
            parts.append(spark.createDataFrame(rows, schema + (", _path string" if with_path else "")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
