"""Schema gates and column presence (checked on the analyzed schema; no job)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, *names: str, what: str = "dataset") -> DataFrame:
    for n in names:
        if n not in df.columns:
            raise ValueError(f"{what}: no column {n!r} among {df.columns}")
    return df


def with_optional_columns(df: DataFrame, names: Iterable[str], dtype: str = "string") -> DataFrame:
    """Absent columns are added as typed nulls so expressions can name them."""
    missing = [n for n in names if n not in df.columns]
    if not missing:
        return df
    return df.withColumns({n: F.lit(None).cast(dtype) for n in missing})


def truthy_string(col: Column) -> Column:
    """Python truthiness of an optional string field: null and '' are false."""
    return F.nullif(col.cast("string"), F.lit(""))


def has_messages(df: DataFrame, name: str = "messages") -> Column:
    """Row has a usable chat list: the column exists and the list is non-empty
    (null, ``""`` and ``[]`` count as absent). Any other value in a column that is
    not a list fails its row, as no chat can be made of it."""
    if name not in df.columns:
        return F.lit(False)
    if not isinstance(df.schema[name].dataType, T.ArrayType):
        value = F.col(name).cast("string")
        bad = F.raise_error(F.concat(F.lit(f"{name} is not a list of messages: "), F.substring(value, 1, 80)))
        return F.when(F.coalesce(value, F.lit("")).isin("", "[]"), F.lit(False)).otherwise(bad.cast("boolean"))
    return F.coalesce(F.size(F.col(name)), F.lit(0)) > 0
