"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import random
import re

import pytest
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("pos", T.StringType()),
                     T.StructField("h", T.StringType()), T.StructField("node", T.StringType()),
                     T.StructField("key", T.StringType())])


def frame(spark, texts, partitions=3):
    """(id, text) pairs as documents with extra columns whose names operators might use."""
    rows = [(i, t, "en", "s", None if t is None else len(t), "pos", "h", "node", "key") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(partitions)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture
def prose():
    """A generator of invented prose, the same in each run."""
    rng = random.Random(3)
    parts = ["an", "the", "ro", "li", "mé", "sto", "ver", "ñ", "qu", "ent", "ou", "x"]
    bag = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(4000)]

    def words(n):
        return " ".join(rng.choices(bag, k=n))
    words.rng = rng
    return words


ODD = [(None, None), (None, ""), (None, "one two"), (900, None), (901, ""), (902, " \t\n "), (903, "Ωmega"),
       (903, "Ωmega"), (904, "\n\n"), (905, "word")]


@pytest.fixture
def odd():
    return list(ODD)
