"""DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Shielded:
    """``df`` with its columns renamed to ``_c0.._cn``, so that an operator's own
    columns never clash with the caller's (repeated names included).

    ``restore`` gives the caller's columns back under their names."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.df = df.toDF(*[f"_c{i}" for i in range(len(self.names))])

    def col(self, name: str) -> str:
        """The internal name of the first column called ``name``."""
        if name not in self.names:
            raise ValueError(f"no column {name!r}; columns are {self.names}")
        return f"_c{self.names.index(name)}"

    @property
    def columns(self) -> list[str]:
        return [f"_c{i}" for i in range(len(self.names))]

    def restore(self, df: DataFrame) -> DataFrame:
        return df.select(*self.columns).toDF(*self.names)


def row_key(row_id: str, text: str) -> list[Column]:
    """``_ka``, ``_kb``: 128 bits that name a row by its id and its text.

    A function of the row's values alone, so any task that reads the row again
    gets the same key; rows that share a key are equal in id and text and are
    treated alike. A null id or text is a value of its own."""
    return [
        F.xxhash64(F.col(row_id).isNull(), F.col(row_id)).alias("_ka"),
        F.xxhash64(F.col(row_id), F.col(text).isNull(), F.col(text)).alias("_kb"),
    ]


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
