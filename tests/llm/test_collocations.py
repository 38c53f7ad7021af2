"""Collocations and the parse below them against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lakestrata.llm import collocations as C

from .conftest import frame, lower


def brute_counts(rows, most):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            lang = "und" if lang is None else lang
            n[lang] += len(words)
            for k in range(1, most + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return f, n


def brute(rows, most=3, least=10, top=2000, covered=50):
    out = []
    f, n = brute_counts(rows, most)
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            score, _, left, right = min((C.SCALE * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                        for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                       for q, b in found.items()):
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    bag = ["the", "of", "New", "new", "york", "ééé", "a\x0bb", "don't", "x", "ü-ber", "z", " q", "Ta\tta"]
    fixed = ["in the city of new york", "as a matter of fact", "to be or not to be to be", "x x x x x"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(bag, k=rng.randint(1, 7)))
                 for _ in range(rng.randint(1, 9))]
        rows.append((rng.choice([" ", ", ", "\n", ". ", "  "]).join(parts), rng.choice(["en", "fr", None, "und"])))
    return rows + [(None, "en"), ("", None), (" \t ,", "fr"), ("word", "de"), ("Ω " * 2000, "e\tl "), ("to be or not. " * 12, "")]


@pytest.mark.parametrize("width,trigger", [(1, 2), (2, 1), (2, 3), (3, 4), (2, 50)])
def test_every_phrase_belongs_to_one_chunk(width, trigger):
    rows = corpus(1)
    want, _ = brute_counts(rows, width + 1)
    texts = pa.array([t or "" for t, _ in rows])
    got = defaultdict(Counter)
    for number, chunk, last in zip(*map(list, C.chunks(texts, width, trigger))):
        words, breaks = re.split("[ \n]", chunk.as_py()), re.findall("[ \n]", chunk.as_py())
        for k in range(1, width + 2):
            own = min(len(words) - k + 1, len(words) if last else len(words) - width)
            got["und" if rows[number][1] is None else rows[number][1]].update(tuple(words[i:i + k]) for i in range(own)
                                                 if "\n" not in breaks[i:i + k - 1])
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_equal_passages_give_equal_chunks():
    rng = random.Random(2)
    passage = " ".join(f"w{rng.randint(0, 99)}" for _ in range(200))
    one, two = (Counter(C.chunks(pa.array([t]), 2, 5)[1].to_pylist())
                for t in (passage, f"some words before {passage} and after"))
    assert len(one) > 20 and sum((one & two).values()) > 0.8 * sum(one.values())


@pytest.mark.parametrize("seed,options", [(3, {}), (4, {"least": 3, "top": 25}), (5, {"most": 4, "least": 5}),
                                          (6, {"most": 2, "covered": 100}), (7, {"least": 2, "covered": 20, "trigger": 2})])
def test_equals_brute_force(spark, seed, options):
    rows = corpus(seed)
    docs = frame(spark, [(i, t) for i, (t, _) in enumerate(rows)]).drop("lang").withColumnRenamed("source", "slot")
    langs = spark.createDataFrame([(i, lang) for i, (_, lang) in enumerate(rows)], "doc_id long, lang string")
    got = C.collocations(docs.join(langs, "doc_id").withColumnRenamed("pos", "phrase").withColumnRenamed("h", "chunk"), **options)
    assert sorted(map(tuple, got.collect())) == brute(rows, **{k: v for k, v in options.items() if k != "trigger"})


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    rows = corpus(8)
    docs = spark.createDataFrame(rows, "text string, lang string")
    made = C.dictionary(docs)
    for bits in (15, 26):
        tables = C.frequent_phrases(spark, made, 3, 4, bits)
        f, _ = brute_counts(rows, 3)
        want = {(lang, " ".join(p), n) for lang, c in f.items() for p, n in c.items() if n >= 4}
        assert {(r.lang, r.phrase, r.n) for t in tables for r in t.collect()} == want


def test_equal_hashes_of_other_words_stay_apart(monkeypatch):
    class Same(C.Words):
        def runs(self, salt=0):
            return lambda a, b: np.zeros(len(a), dtype=np.uint64)

    monkeypatch.setattr(C, "Words", Same)
    made = Counter()
    for batch in C.counted(pa.array(["en"] * 2), pa.array(["a b c a b", "b c"]), np.array([True, True]), np.array([1, 10]),
                           (1, 2), 2, None, 26):
        for phrase, n in zip(*(c.to_pylist() for c in batch.columns)):
            made[phrase] += n
    assert made == {f"{k}\ten": n for k, n in {"a": 2, "b": 12, "c": 11, "a b": 2, "b c": 11, "c a": 1}.items()}


def test_counts_beyond_64_bits(spark):
    chunk = spark.createDataFrame([("en", "a b", True, 5_000_000_000), ("en", "b", True, 9_000_000_000)],
                                  "lang string, chunk string, last boolean, n long")
    tables = C.frequent_phrases(spark, chunk, 2)
    assert [r.n for r in tables[1].collect()] == [5_000_000_000]
    row = spark.range(1).selectExpr("5000000000 as a", "5000000000 as l", "14000000000 as r").selectExpr(
        f"(cast({C.SCALE} as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(15,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) as score").first()
    assert row.score == 10**6 * 5_000_000_000**2 // (5_000_000_000 * 14_000_000_000)


def test_empty(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert C.collocations(docs).count() == 0
    with pytest.raises(ValueError, match="two words"):
        C.collocations(docs, most=1)
