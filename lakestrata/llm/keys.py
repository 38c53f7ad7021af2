"""Row identity shared by the corpus operators.

A row of ``documents`` is identified by its id and a 31-bit hash of its text:
null ids and repeated ids with different texts stay apart, and rows that
repeat both id and text count as one document (each still gets its output
row).  A caller's columns travel in one struct beside the key, or the added
columns take names that the caller's do not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_ID = -(1 << 63)      # stands for a null id inside joins
KEY = ["__kid", "__kh"]


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many more underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def added(df: DataFrame, *names: str) -> None:
    """Columns that an operator adds must not be there."""
    clash = {n for n in names if n.lower() in {c.lower() for c in df.columns}}
    if clash:
        raise ValueError(f"{sorted(clash)} are columns already; name others (see keys.free)")


def key_columns(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("__kid"),
            F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), 33).cast("int").alias("__kh")]


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__kid, __kh, __text): key and whole text (null: empty) only."""
    return df.select(*key_columns(id_col, text_col),
                     F.coalesce(F.col(text_col), F.lit("")).alias("__text"))


def with_key(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``df`` and the key."""
    return df.select("*", *key_columns(id_col, text_col))


def as_row(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``df``, so that no name can clash) and the key."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *key_columns(id_col, text_col))
