"""Periodic runs against brute force: online, in batches and as a table."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm import runs
from lakestrata.llm.runs import Catchers, periodic_runs

from .conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, exponent, least):
    """Every maximal stretch of every distance; of those with one span the smallest distance is the period."""
    best = {}
    for p in range(1, len(words) // exponent + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, exponent * p):
                best.setdefault((i, j + p), p)
            i = max(j, i) + 1
    return sorted((s, e - s, p) for (s, e), p in best.items())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def shapes():
    rng = random.Random(5)
    thue = [format(i, "b").count("1") % 2 for i in range(300)]
    yield from ([], ["a"], ["a"] * 7, ["a"] * 200, ["a", "b"] * 60, fibonacci(200), thue, thue[:64] * 5)
    for _ in range(60):
        words = []
        while len(words) < rng.choice([30, 150, 400]):
            part = [rng.choice("abc") for _ in range(rng.randint(1, 20))]
            words += part * rng.choice([1, 1, 2, 4, 7]) + part[:rng.randint(0, len(part))]
        yield words


def as_bytes(words):
    return [str(w).encode() for w in words]


@pytest.mark.parametrize("exponent,least", [(2, 2), (2, 9), (3, 3), (4, 6)])
def test_all_runs_of_all_documents_in_one_stream(exponent, least):
    docs = [as_bytes(w) for w in shapes()]
    got = periodic_runs(docs, exponent, least)
    for words, found in zip(docs, got):
        assert list(map(tuple, found.tolist())) == brute(words, exponent, least)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.lists(st.integers(1, 9), min_size=1, max_size=30))
def test_words_may_come_in_any_portions(words, portions):
    values = np.array([hash(str(w)) for w in words], dtype=np.int64).view(np.uint64)
    online, at = Catchers(2, 2), 0
    for size in [*portions, *[1] * 60]:
        online.append(values[at:at + size])
        at = min(len(words), at + size)
        assert list(map(tuple, online.runs().tolist())) == brute(words[:at], 2, 2)


def test_one_word_at_a_time():
    for words in list(shapes())[:25]:
        values = np.array([hash(str(w)) for w in words], dtype=np.int64).view(np.uint64)
        online = Catchers(3, 3)
        for i in range(len(words)):
            online.append(values[i:i + 1])
        assert list(map(tuple, online.runs().tolist())) == brute(words, 3, 3)


def test_many_equal_words_take_little_time():
    assert [r.tolist() for r in periodic_runs([[b"a"] * 300_000, [b"a", b"b"] * 100_000])] == [
        [[0, 300_000, 1]], [[0, 200_000, 2]]]


def test_table(spark, prose, odd):
    texts = [*odd, (1, "x y z " * 9), (1, "x y z " * 9), (2, prose(3000)), (3, " ".join([prose(700)] * 5) + " end"),
             (4, "\n".join(["a"] * 6)), (5, "a a a a a"), (None, "b " * 8)]
    docs = frame(spark, texts).withColumnRenamed("pos", "start").withColumnRenamed("h", "__runs")
    got = runs.with_runs(docs, runs="spans", kept="left over")
    assert got.columns == [*(c for c in docs.columns if c != "text"), "spans", "left over"]
    want = []
    for i, t in texts:
        words = WORD.findall(t or "")
        spans = brute(words, 4, 6)
        gone = {k for s, n, p in spans for k in range(s + p, s + n)}
        want.append((str(i), spans, " ".join(w for k, w in enumerate(words) if k not in gone)))
    assert sorted((str(r.doc_id), [tuple(s) for s in r.spans], r["left over"]) for r in got.collect()) == sorted(want)
    assert runs.with_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="runs="):
        runs.with_runs(docs.withColumnRenamed("node", "runs"))
