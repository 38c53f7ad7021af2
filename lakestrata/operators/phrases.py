"""Positional phrase index (F3 over stored postings): build once, look phrases up by the asked words' folders.

A word is a run of ``[a-z0-9_]`` of the lower-cased text, as in
``jobs.phrase_filter(whole_words=True)``, whose rows the search gives.  The index
has a row for each occurrence: key, hash of the row's texts, column, position, word and the
text between it and the word before.  It lies in folders by a hash of the
word, sorted by it, so a search opens the folders of its words and
there only the row groups that hold them.  A frequent word's folder is written by several tasks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = "[a-z0-9_]+"
PART = "word_part"


def _part(word: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(parts)).cast("int")


def text_hash(cols: list[str]) -> Column:
    """Tells rows of one key with different texts from each other."""
    return F.xxhash64(F.lit(0), *[F.coalesce(F.sha2(F.col(c), 256), F.lit("")) for c in cols])


def occurrences(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One row per word of each column: ``key``, ``texts``, ``field``, ``position``, ``word``, ``gap``.

    Null and empty texts have none; every column counts its own positions, so no phrase spans two of them."""
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.lower(F.col(c)).alias("text")) for c in cols])
    rows = df.select(F.col(key).alias("key"), text_hash(cols).alias("texts"), F.inline(fields))
    words = F.expr(f"regexp_extract_all(text, '({WORD})', 1)")
    gaps = F.expr(f"regexp_extract_all(text, '([^a-z0-9_]*){WORD}', 1)")
    return rows.select("key", "texts", "field", F.posexplode(F.arrays_zip(words.alias("word"), gaps.alias("gap")))
                       .alias("position", "_w")).select("key", "texts", "field", "position", "_w.word", "_w.gap")


def write_index(df: DataFrame, path: str, key: str, cols: list[str], parts: int, fmt: str = "parquet") -> None:
    """Index ``cols`` of ``df``; ``parts`` is fixed for the index's life and given again to ``search``."""
    (occurrences(df, key, cols).withColumn(PART, _part(F.col("word"), parts))
     .hint("rebalance", PART).sortWithinPartitions(PART, "word")
     .write.format(fmt).mode("overwrite").partitionBy(PART).save(path))


def search(spark: SparkSession, path: str, phrase: str, parts: int, key_type: str = "string",
           fmt: str = "parquet") -> DataFrame:
    """(key, texts) of the rows with ``phrase`` in a column, once each; ``key_type`` is the key's type.

    Every occurrence of the phrase's word ``i`` at ``p`` votes for a start at ``p - i``; a
    start with votes of all words is a match.  One aggregate, whatever the number of words.
    The phrase begins and ends with a word character; others are for ``phrase_filter``.
    """
    needle = phrase.lower()
    words = re.findall(WORD, needle)
    gaps = re.split(WORD, needle)
    if not words or gaps[0] or gaps[-1]:
        raise ValueError(f"not a phrase of whole words: {phrase!r}")
    index = spark.read.schema(f"key {key_type}, texts long, field string, position int, word string, gap string, "
                              f"{PART} int").format(fmt).load(path)
    folders = spark.range(1).select(*[_part(F.lit(w), parts) for w in words]).first()
    own = index.where(F.col(PART).isin(*sorted(set(folders))) & F.col("word").isin(*sorted(set(words))))
    places = [F.when((F.col("word") == w) & (F.lit(i == 0) | (F.col("gap") == gaps[i])), F.lit(i))
              for i, w in enumerate(words)]
    votes = own.select("key", "texts", "field", "position", F.explode(F.array_compact(F.array(*places))).alias("_i"))
    return (votes.groupBy("key", "texts", "field", (F.col("position") - F.col("_i")).alias("_start"))
            .agg(F.count_distinct("_i").alias("_n")).where(F.col("_n") == len(words))
            .select("key", "texts").distinct())


def holding(df: DataFrame, hits: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """The rows of ``df`` that a search found, repeated rows and null keys included."""
    found = hits.select(F.col("key").alias("_key"), F.col("texts").alias("_texts"))
    return df.join(found, df[key].eqNullSafe(F.col("_key")) & (text_hash(cols) == F.col("_texts")), "left_semi")
