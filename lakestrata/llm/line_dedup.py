"""Line dedup: drop lines that many documents share, keep one copy of each.

Lines are exploded with their position, normalised (white space stripped at
both ends, A-Z lower-cased) and hashed to 128 bits; distinct documents are
counted per hash (pre-aggregated before each shuffle), lines of frequent hashes
are marked by position and the text is put together again from the rest.

Cases: null and empty texts are one empty line; a document is its id, so rows that
repeat an id count once for each line, and all of them keep it if theirs is the largest id; rows
without an id are one document below every other; a line repeated inside one document
counts that document once; an empty table gives an empty result; extra columns pass through
``without_shared_lines`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .keys import KEY, as_row, keyed

MIN_CHARS = 40
MIN_DOCS = 5
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def line_table(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(__kid, __kh, pos, h): the lines long enough to be judged."""
    lines = (keyed(docs, id_col, text_col)
             .select(*KEY, F.posexplode(F.split("__text", "\n", -1)).alias("pos", "line"))
             .filter(F.char_length("line") >= min_chars)
             .select(*KEY, "pos", line_key(F.col("line")).alias("key")))
    return (lines.filter(F.char_length("key") >= min_chars)
            .select(*KEY, "pos", F.unhex(F.md5("key")).alias("h")))


def shared_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h, n_docs, keep): hashes in at least ``min_docs`` documents (ids) and the id that keeps them."""
    return (lines.select("h", "__kid").distinct()
            .groupBy("h").agg(F.count(F.lit(1)).alias("n_docs"), F.max("__kid").alias("keep"))
            .filter(F.col("n_docs") >= min_docs))


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(__kid, __kh, dropped): positions (from 0) of the lines that each row loses.

    The shared lines are written to the session's shared folder first: both
    sides of the join are then shuffled for it, and adaptive execution can
    split a hot line's rows.  The list of a row is bounded by its own lines.
    """
    spark = docs.sparkSession
    lines = line_table(docs, min_chars, id_col, text_col)
    shared = shared_lines(lines, min_docs)
    folder = scratch_path(spark, "lines")
    shared.write.parquet(folder)
    hits = (lines.join(spark.read.schema(shared.schema).parquet(folder), "h")
            .filter(F.col("__kid") != F.col("keep")))
    return hits.select(*KEY, "pos").distinct().groupBy(*KEY).agg(
        F.collect_list("pos").alias("dropped"))


def with_kept_text(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, kept, n_lines, n_lost): ``row`` holds all columns of ``docs``, ``kept`` the text that is left."""
    drops = dropped_positions(docs, min_chars, min_docs, id_col, text_col)
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    rows = (as_row(docs, id_col, text_col).join(drops, KEY, "left")
            .select("row", "dropped", F.split(text, "\n", -1).alias("lines")))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    left = F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n")
    return rows.select("row", F.when(F.col("dropped").isNull(), text).otherwise(left).alias("kept"),
                       F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_lost"))


def without_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                         id_col: str = "doc_id", text_col: str = "text",
                         size_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the shared lines gone from its text; null texts stay null."""
    out = with_kept_text(docs, min_chars, min_docs, id_col, text_col)
    text = F.when(F.col(f"row.`{text_col}`").isNotNull(), F.col("kept"))
    change = {text_col: text, size_col: F.char_length(text).cast("long")}
    return out.select(*[change.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
