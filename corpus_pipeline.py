"""Corpus pipeline: five stages over ``documents``, each on all that the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet into the session's shared folder and reads it back as
the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm import decontaminate, language_id, line_dedup, ngram_join, sentence_pieces
from lakestrata.llm.keys import free
from lakestrata.session import ensure_utc, scratch_path


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned from the labelled documents.  Those without any letter go, and those in which the network tells no
    language from the others (``language_id.undecided``); all others stay as they are.  Where nothing could be
    learned, the letters alone decide."""
    model = language_id.train(docs)
    lang, score = free(docs, "lang_found", "lang_score")
    seen = language_id.with_language(docs, model, lang_out=lang, score_out=score)
    if not model.languages:
        keep = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    else:
        keep = (F.col(lang) != language_id.UNKNOWN) & (F.col(score) > language_id.undecided(model))
    return seen.filter(keep).drop(lang, score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go from the texts (all but one copy); ``n_chars`` follows."""
    return line_dedup.without_shared_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return ngram_join.representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    leaks, = free(docs, "leaks")
    found = decontaminate.with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=leaks)
    return found.filter(~decontaminate.leaked(leaks)).drop(leaks)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text as piece ids; a text that the ids don't give back would be an error."""
    rows = sentence_pieces.encoded(docs.select("doc_id", "lang", "source", "text"), sentence_pieces.Vocabulary.load())
    whole = F.col("__decoded") == F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "lang", "source", F.size("__ids").cast("long").alias("n_tokens"),
                       F.col("__piece_score").alias("score"),
                       F.when(whole, F.col("__ids")).otherwise(F.raise_error(
                           F.lit("a text doesn't survive its encoding"))).alias("ids"))


STAGES = [("language ID", languages), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", benchmark), ("SentencePiece encoding", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    folder = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs


#: A trained network, a similarity join and a segmentation are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
