import itertools
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestrata.llm.wordhash import Words, buffers, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tabAB é漢\x0b\x1c ", max_size=25), max_size=8))
def test_words_and_hashes_are_those_of_the_texts(texts):
    w = Words(pa.array(texts, pa.string()), lower=True)
    want = [WORD.findall(t) for t in texts]
    assert w.count.tolist() == [len(x) for x in want]
    got = [[w.word(i).decode() for i in range(w.first[r], w.first[r + 1])] for r in range(len(texts))]
    assert got == want
    flat = list(itertools.chain.from_iterable(want))
    by = {}
    for word, h in zip(flat, w.hash.tolist()):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), word)
        assert by.setdefault(low, h) == h
    assert len(set(by.values())) == len(by)


def test_runs_are_equal_where_their_words_are():
    w = Words(pa.array(["a b c a b c", "c a b", "ab c"]))
    runs = w.runs()
    n = len(w)
    hashes = {}
    for a in range(n):
        for b in range(a, n + 1):
            key = tuple(w.word(i) for i in range(a, b))
            h = int(runs(np.array([a]), np.array([b]))[0])
            assert hashes.setdefault(key, h) == h
    assert len(set(hashes.values())) == len(hashes)


def test_slices_cover_all_rows_of_a_sliced_batch():
    texts = ["x" * n for n in (0, 5, 50, 1, 0, 7, 200, 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]).slice(1)
    parts = list(slices(batch, "t", 20))
    assert [v for p in parts for v in p.column(0).to_pylist()] == texts[1:]
    assert buffers(parts[0].column(0))[1][0] == 0
    assert list(slices(batch.slice(0, 0), "t")) == []
