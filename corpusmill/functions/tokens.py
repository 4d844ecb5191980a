"""Token arrays as native column expressions.

The built-in encoder maps a text to its Unicode code points (one id per code
point, also above U+FFFF), entirely inside the JVM. Plug-in tokenizers run
through ``functions.udf.encode_with``. Truncation cuts the encoded ids; the
tail (or head, for ``side='left'``) is discarded. No padding, no packing: one
row in, one row out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL_MAX_FALLBACK = 8192  # used when a tokenizer reports no model_max_length


def encode_codepoints(text: Column) -> Column:
    """``array<int>`` of code points; null and '' give ``[]``."""
    t = F.coalesce(text, F.lit(""))
    return F.when(t == "", F.array().cast("array<int>")).otherwise(
        F.transform(F.split(t, ""), lambda c: F.ascii(c))
    )


def truncate(ids: Column, max_len: int | Column, side: str = "right") -> Column:
    n = max_len if isinstance(max_len, Column) else F.lit(int(max_len))
    if side == "right":
        return F.slice(ids, F.lit(1), n)
    if side == "left":
        return F.slice(ids, F.greatest(F.size(ids) - n, F.lit(0)) + 1, n)
    raise ValueError("side must be 'right' or 'left'")


def cut_text(text: Column, max_len: int | Column, side: str = "right") -> Column:
    """The first (``right``) or last (``left``) ``max_len`` characters. Spark
    strings count code points, so ``encode_codepoints(cut_text(t, n, s))``
    equals ``truncate(encode_codepoints(t), n, s)`` without building the ids
    of the discarded part."""
    n = max_len if isinstance(max_len, Column) else F.lit(int(max_len))
    if side == "right":
        return F.substring(text, F.lit(1), n)
    if side == "left":
        return F.substring(text, -n, n)
    raise ValueError("side must be 'right' or 'left'")


def encode_truncated(text: Column, max_len: int | Column | None, side: str = "right") -> Column:
    """Code points of ``text`` cut to ``max_len`` tokens (``None``: no cut)."""
    if max_len is None:
        return encode_codepoints(text)
    return encode_codepoints(cut_text(text, max_len, side))


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def effective_max_length(question_max_length: int = 10000, model_max_length: int | None = None) -> int:
    """``min(question_max_length, model_max_length or 8192)``."""
    return min(int(question_max_length), int(model_max_length or MODEL_MAX_FALLBACK))


def tokenize(
    df: DataFrame,
    text_col: str = "text",
    max_len: int | None = 2048,
    side: str = "right",
    encoder=None,
    labels: bool = False,
    drop_text: bool = False,
) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask`` (and ``labels``, a plain copy of
    ``input_ids``: prompt tokens are not masked). ``encoder`` is a Column
    function ``text -> array<int>``; default is the code-point encoder."""
    if encoder is None:
        ids = encode_truncated(F.col(text_col), max_len, side)
    else:
        ids = encoder(F.col(text_col))
        if max_len is not None:
            ids = truncate(ids, max_len, side)
    out = df.withColumn("input_ids", ids).withColumn("attention_mask", attention_mask(F.col("input_ids")))
    if labels:
        out = out.withColumn("labels", F.col("input_ids"))
    if drop_text:
        out = out.drop(text_col)
    return out
