"""The positional index gives the rows of the phrase filter and opens only the asked words' folders."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import jobs as J
from lakestrata.operators import phrases as PH
from lakestrata.session import scratch_path

PARTS = 16
ROWS = [("a", "Data engineer", "Builds the data platform."), ("b", "data  engineer", None), ("c", "engineer data", "data-engineer"),
        ("d", "big data", "engineer"), ("e", None, None), ("f", "", " "), (None, "DATA ENGINEER!", "x"),
        ("g", "metadata engineer", "data engineers"), ("h", "C++ data engineer", "the the the data engineer"),
        ("a", "Data analyst", "other text, same id"), ("a", "Data engineer", "Builds the data platform."),
        ("i", "data_engineer", "É data engineer é"), ("j", "data", "engineer")]


@pytest.fixture(scope="module")
def indexed(spark):
    rng = random.Random(2)
    bag = ["data", "Engineer", "the", "of", "a", "..."]
    rows = ROWS + [(f"r{i}", " ".join(rng.choices(bag, k=rng.randint(0, 9))), ",".join(rng.choices(bag, k=rng.randint(0, 400))))
                   for i in range(150)]
    df = spark.createDataFrame(rows, "job_id string, title string, description string")
    path = scratch_path(spark, "phrase_index")
    PH.write_index(df, path, "job_id", ["title", "description"], PARTS)
    return df, path


@pytest.mark.parametrize("phrase", ["data engineer", "the", "THE the the", "of the data a", "data, engineer",
                                    "the,the,of", "data-engineer", "nothing here", "data,...,data"])
def test_equals_the_phrase_filter(spark, indexed, phrase):
    df, path = indexed
    got = PH.holding(df, PH.search(spark, path, phrase, PARTS), "job_id", ["title", "description"])
    want = J.phrase_filter(df, phrase, ["title", "description"], whole_words=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_only_the_folders_of_the_words_are_opened(spark, indexed, capsys):
    _, path = indexed
    PH.search(spark, path, "data engineer", PARTS).explain("formatted")
    plan = capsys.readouterr().out
    assert "word_part" in re.search(r"PartitionFilters: \[([^\n]*)\]", plan).group(1)
    assert "In(word, [data,engineer])" in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_phrases_that_are_not_whole_words_are_refused(spark, indexed):
    for phrase in ("", "...", ".net", "c++", "é data"):
        with pytest.raises(ValueError):
            PH.search(spark, indexed[1], phrase, PARTS)


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "job_id string, title string")
    path = scratch_path(spark, "phrase_index_empty")
    PH.write_index(df, path, "job_id", ["title"], PARTS)
    assert PH.search(spark, path, "data", PARTS).count() == 0


def test_every_column_counts_for_itself(spark, indexed):
    df, path = indexed
    hits = {r.key for r in PH.search(spark, path, "big data engineer", PARTS).collect()}
    assert "d" not in hits
    assert PH.occurrences(df.limit(0), "job_id", ["title"]).columns == ["key", "texts", "field", "position", "word", "gap"]
