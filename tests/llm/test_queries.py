"""The registered queries against their SQL, the pipeline against a brute-force one."""

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from lakestrata.llm import queries
from tools.check_oracle import compare, duck

from .conftest import frame, lower
from .test_dedup_joins import brute_components
from .test_line_dedup import brute as brute_lines

SMOKE_DIR = "/root/testdata/sf0.001"
COLUMNS = {1: "doc_id n_assign n_access n_hex base_sha256 spans", 3: "doc_id n_shingles component_id",
           5: "doc_id n_words n_removed kept_sha256", 6: "query_id rank vec_id score",
           7: "page_id payload_bytes payload_digest record_type refers_to", 8: "doc_id held_out lang_pred score",
           9: "page_id url text n_chars", 10: "doc_id n_lines n_dropped kept_sha256",
           11: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
           12: "lang rank phrase a l r n score",
           13: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars"}


def key(n):
    return next(k for k in queries.QUERIES if k.startswith(f"op{n}_"))


def test_all_operators_and_the_pipeline_are_registered():
    names = E.queries()
    assert all(sum(k.startswith(f"op{n}_") for k in names) == 1 for n in range(1, 14)) and "pipeline" in names
    assert set(queries.ORACLE) == {key(n) for n in (1, 7, 10, 11, 12, 13)} and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("n", [1, 7, 10, 11, 12, 13])
def test_matches_oracle(spark, n):
    res = compare(spark, duck(SMOKE_DIR), key(n), queries.QUERIES[key(n)], queries.ORACLE[key(n)], SMOKE_DIR)
    assert res["status"] == "ok", res


@pytest.mark.parametrize("n", sorted(COLUMNS))
def test_columns(spark, n):
    df = queries.QUERIES[key(n)](spark, SMOKE_DIR)
    assert set(COLUMNS[n].split()) <= set(df.columns)
    table, own = {6: ("embeddings", None), 12: ("documents", None), 13: ("conversations", None), 7: ("pages", "page_id"), 9: ("pages", "page_id")}.get(n, ("documents", "doc_id"))
    if own:
        rows = spark.read.parquet(f"{SMOKE_DIR}/{table}.parquet")
        assert sorted(r[0] for r in df.select(own).collect()) == sorted(r[0] for r in rows.select(own).collect())


def test_substrings_and_digests_of_the_smoke_table(spark):
    from .test_dedup_joins import brute_substrings
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMOKE_DIR}/documents.parquet").collect()]
    want = {(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute_substrings(docs, 35)}
    got = queries.QUERIES[key(5)](spark, SMOKE_DIR).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert set(map(tuple, got.collect())) == want


def test_the_pipeline_equals_a_plain_one(spark, prose, tmp_path):
    items = [(k, prose(40)) for k in range(6)]
    shared = "a shared line of more than forty characters, É and all"
    base = prose(90)
    texts = [(i, "\n".join([prose(30), shared, prose(12)])) for i in range(12)]
    texts += [(20, base), (21, base + " tail"), (22, base.upper()), (23, "123 456 !!"), (24, None), (25, "")]
    texts += [(30 + k, f"{prose(50)} {items[k][1]} {prose(9)}") for k in range(3)] + [(40, prose(2500)), (41, "one"), (42, "one")]
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = [(i, t) for i, t in texts if t and re.search(r"[^\W\d_]", t)]
    kept = [(i, t) for i, _, _, t in brute_lines(kept)]
    first = {i for i, _, c in brute_components(kept) if i == c}
    kept = [(i, t) for i, t in kept if i in first and not any(lower(x) in lower(t) for _, x in items)]
    got = corpus_pipeline.run(spark, str(tmp_path))
    from lakestrata.llm.sentence_pieces import Vocabulary, decode
    table = Vocabulary.load().table
    assert sorted((r.doc_id, decode(table, r.ids)) for r in got.collect()) == sorted(kept)
    assert {30, 31, 32} & {i for i, _ in kept} == set() and 20 in first and 21 not in first


def test_stages_keep_the_columns_of_documents(spark, tmp_path, prose):
    docs = frame(spark, [(1, prose(20)), (None, None), (2, "")])
    spark.createDataFrame([(1, prose(30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            out = stage(spark, rows, str(tmp_path))
            assert out.columns == docs.columns and out.count() <= 3


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.abspath(E.__file__))
    for folder, _, names in os.walk(os.path.join(root, "lakestrata")):
        if f"{os.sep}llm" not in folder:
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as f:
                        assert "llm" not in f.read(), name


def test_a_pipeline_without_labels_and_with_clashing_names(spark, tmp_path, prose):
    docs = frame(spark, [(1, prose(20)), (2, "12 34"), (3, prose(30)), (4, None)])
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in corpus_pipeline.languages(spark, bare, "").collect()) == [1, 3]
    spark.createDataFrame([(1, prose(30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    odd = docs.withColumnsRenamed({"pos": "lang_found", "h": "__kid", "node": "leaks", "key": "__lang"})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(tmp_path))
        assert out.columns == odd.columns and {r["leaks"] for r in out.collect()} == {"node"}
