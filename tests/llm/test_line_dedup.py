from collections import defaultdict

import duckdb

from lakestrata.llm import line_dedup, ngram_join, queries

from .conftest import frame, lower


def brute(texts):
    keys = lambda t: [lower(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")]
    held = defaultdict(set)
    ident = lambda i: (i is not None, i or 0)
    for i, t in texts:
        for k in keys(t):
            if len(k) >= 40:
                held[k].add(ident(i))
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        keep = [x for x, k in zip(lines, keys(t))
                if len(k) < 40 or len(held[k]) < 5 or ident(i) == max(held[k])]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def test_shared_lines_go_but_for_one_copy(spark, prose, odd):
    shared = ["Permission is hereby granted, free of charge, to any Person É", "x" * 39, "y" * 40]
    texts = list(odd)
    for i in range(12):
        lines = [prose(9) for _ in range(4)] + [shared[0].upper().replace("É", "é") if i == 3 else f"\t {shared[0]}\r"]
        lines += [shared[1], shared[2] if i < 5 else prose(3), shared[2] if i == 4 else ""]
        prose.rng.shuffle(lines)
        texts.append((i, "\n".join(lines)))
    docs = frame(spark, texts)
    got = line_dedup.with_kept_text(docs).select("row.doc_id", "n_lines", "n_lost", "kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(texts)
    assert sum(r[2] for r in got) > 10


def test_columns_pass_and_sizes_follow(spark):
    line = "a line that is shared by many documents, long enough"
    texts = [(i, f"own {i}\n{line}") for i in range(6)] + [(7, None)]
    docs = frame(spark, texts)
    out = line_dedup.without_shared_lines(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text == "own 0" and rows[0].n_chars == 5 and rows[5].text == f"own 5\n{line}"
    assert rows[7].text is None and rows[0].pos == "pos"


def test_an_empty_table_and_a_hot_line(spark):
    assert line_dedup.without_shared_lines(frame(spark, [])).count() == 0
    hot = "this very line stands in every third document of the table"
    texts = [(i, f"{i}\n{hot}" if i % 3 == 0 else f"{i}") for i in range(300)]
    out = {r.doc_id: r.text for r in line_dedup.without_shared_lines(frame(spark, texts)).collect()}
    assert [i for i, t in out.items() if hot in t] == [297]


def test_a_document_is_its_id(spark, tmp_path):
    line = "a line that is shared by many documents, long enough"
    few = [(i, f"{i} {k}\n{line}") for k, i in enumerate([0, 1, 2, 3, 3])]
    more = [(i, f"{i} {k}\n{line}") for k, i in enumerate([0, 1, 2, 3, 9, 9, None])]
    for n, texts in enumerate((few, more)):
        docs = frame(spark, texts)
        got = line_dedup.with_kept_text(docs).select("row.doc_id", "n_lines", "n_lost", "kept").collect()
        assert sorted(map(tuple, got), key=str) == brute(texts)
        with_ids = docs.filter("doc_id is not null")
        with_ids.write.parquet(str(tmp_path / f"{n}" / "documents.parquet"))
        rows = sorted((r.doc_id, r.n_dropped) for r in queries.QUERIES["op10_line_dedup"](spark, str(tmp_path / f"{n}")).collect())
        con = duckdb.connect()
        con.execute(f"create view documents as select row_number() over () as rid, * from '{tmp_path}/{n}/documents.parquet/*.parquet'")
        sql = queries.ORACLE["op10_line_dedup"].replace("SELECT doc_id, string_split", "SELECT doc_id, rid, string_split").replace(
            "unnest(lines)", "rid, unnest(lines)").replace("SELECT k.doc_id", "SELECT k.rid, k.doc_id").replace("GROUP BY doc_id", "GROUP BY doc_id, rid")
        assert rows == sorted((r[0], r[2]) for r in con.execute(sql).fetchall())


def test_the_librarys_own_names(spark):
    texts = [(i, f"{i}\na line that is shared by many documents, long enough") for i in range(6)]
    docs = frame(spark, texts).withColumnsRenamed(
        {"pos": "__kid", "h": "__kh", "node": "dropped", "key": "row", "source": "kept", "lang": "lines"})
    out = line_dedup.without_shared_lines(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.text, r["__kid"], r.kept) for r in out.collect()) == [
        (i, t if i == 5 else str(i), "pos", "s") for i, t in texts]
    assert ngram_join.representatives(docs).count() == ngram_join.representatives(frame(spark, texts)).count()


def test_hundreds_of_dropped_lines_in_one_text(spark):
    lines = [f"line number {k} of a text that many documents repeat in full" for k in range(3000)]
    texts = [(i, "\n".join([*lines, str(i)])) for i in range(6)]
    out = {r.doc_id: r.text for r in line_dedup.without_shared_lines(frame(spark, texts)).collect()}
    assert out[0] == "0" and out[5].count("\n") == 3000
