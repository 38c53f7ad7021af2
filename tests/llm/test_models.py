"""Language ID, decontamination, nearest neighbours and SentencePiece against brute force."""

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import ann, decontaminate, language_id, sentence_pieces
from lakestrata.llm.wordhash import Words

from .conftest import WORD, frame, lower

# ---- language ID


def tongue(rng, letters, n):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(n))


LETTERS = {"aa": "abcdeéè", "bb": "fghijüß", "cc": "клмноп", "dd": "qrstuvñ"}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(i, tongue(rng, LETTERS[lang], rng.randint(2, 90)), lang)
            for i, lang in enumerate(rng.choices(list(LETTERS), k=500))]
    rows += [(600, None, "aa"), (601, "", "bb"), (602, "123 !!", "cc"), (None, "abc", "aa"), (603, "abcde", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def test_held_out_accuracy_and_held_out_rows(labelled):
    model = language_id.train(labelled, per_language=60)
    assert model.languages == tuple(sorted(LETTERS))
    rows = language_id.with_language(labelled.withColumn(
        "held_out", language_id.held_out(F.col("doc_id"))), model).collect()
    for r in rows:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r["__score"] <= 1
    by = {r.doc_id: r for r in rows}
    assert all(by[i]["__lang"] == "und" and by[i]["__score"] == 0 for i in (600, 601, 602))
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 500]
    assert np.mean([r["__lang"] == r.lang for r in held]) > 0.95


def test_the_labels_of_held_out_rows_are_not_learned(spark):
    rows = [(i, "abc def", "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else "aa") for i in range(60)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("aa",)


def test_every_label_is_learned(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id, "fit", lambda texts: seen.append(texts))
    rows = [(5 * i + k, f"abc {i}", f"l{i:03d}") for i in range(230) for k in range(4 + 3 * (i == 0))]
    rows += [(7, f"same id {i}", "zz") for i in range(90)]
    language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=2)
    learned = [lang for lang, _ in seen[0]]
    kept = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 5}
    assert len(kept) > 220 and set(learned) == kept and max(learned.count(x) for x in kept) == 2


def test_scores_cover_whole_texts_and_tables_without_labels(spark, labelled):
    model = language_id.train(labelled, per_language=60)
    texts = ["abcde " * 40 + "клмноп " * 400, "q", "", "é"]
    langs, scores = language_id.classify(pa.array(texts), model)
    assert langs[0] == "cc" and langs[2] == "und"
    one, score = language_id.classify(pa.array(texts[:1]), model)
    assert one[0] == langs[0] and abs(score[0] - scores[0]) < 1e-5
    empty = frame(spark, [])
    assert language_id.with_language(empty, language_id.train(empty)).count() == 0
    assert {r["__lang"] for r in language_id.with_language(frame(spark, [(1, "abc")]), language_id.fit([])).collect()} == {"und"}


def test_gradients_follow_the_loss():
    rng = random.Random(4)
    pairs = [(lang, tongue(rng, letters, 20)) for lang, letters in LETTERS.items() for _ in range(20)]
    model = language_id.fit(pairs)
    x = np.concatenate([language_id.cut(np.frombuffer(t.encode(), np.uint8))[:1] for _, t in pairs])
    right = model.probabilities(x).argmax(axis=1) == [model.languages.index(lang) for lang, _ in pairs]
    assert right.mean() > 0.95
    assert all((t[0] == 0).all() for t in model.tables)     # padding adds nothing


# ---- decontamination


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, doc_id string")


def test_planted_items_are_found_and_clean_documents_are_not(spark, prose, odd):
    items = [(i, prose(prose.rng.randint(30, 60)), "x") for i in range(50)] + [(90, None, "x"), (91, " ", "x"), (92, "zyx wvu", "x")]
    texts, leaks = list(odd), set()
    for i in range(80):
        parts = [prose(prose.rng.randint(0, 400))]
        for k in prose.rng.sample(range(50), prose.rng.choice([0, 0, 1, 2])):
            words = "".join(c.upper() if c.isascii() else c for c in items[k][1]).split(" ")
            if prose.rng.random() < 0.5:
                words[prose.rng.randrange(len(words) // 2)] = "other"
            parts += [" \n".join(words), prose(prose.rng.randint(0, 30))]
            leaks.add((i, k))
        texts.append((i, " ".join(parts)))
    texts += [(200, "and ZYX wvu."), (201, "and ZYX wvu .")]
    found = decontaminate.with_leaks(frame(spark, texts), benchmark(spark, items))
    got = {(r.doc_id, x.item_id) for r in found.collect() for x in r["__leaks"]}
    assert got == leaks | {(201, 92)}
    shards = decontaminate.with_leaks(frame(spark, texts), benchmark(spark, items), shard_bytes=2000)
    assert {(r.doc_id, x.item_id) for r in shards.collect() for x in r["__leaks"]} == got
    assert found.columns[:-1] == frame(spark, []).columns


def test_many_shards_give_the_rows_of_one(spark, prose):
    """One shard at a time, with repeated rows, null texts and columns of the operator's own names."""
    items = [(i, prose(40), "x") for i in range(12)] + [(99, prose(20), "x")] * 2
    texts = [(1, items[0][1] + " " + items[7][1]), (2, None), (None, items[3][1]), (4, ""), (5, prose(50)), (6, items[12][1])]
    docs = spark.createDataFrame([(i, t, "a", n) for n in range(3) for i, t in texts], "doc_id long, text string, text_hash string, leaks int")
    rows = lambda df: sorted(map(str, df.collect()))
    one = decontaminate.with_leaks(docs, benchmark(spark, items), out="found")
    many = decontaminate.with_leaks(docs, benchmark(spark, items), out="found", shard_bytes=500)
    assert many.columns == one.columns and rows(many) == rows(one) and many.count() == 18
    assert sum(len(r.found) for r in many.collect()) == 3 * (2 + 1 + 2)
    held = [len(i.ids) for i in decontaminate.shards(benchmark(spark, items), "item_id", "text", 500)]
    assert len(held) > 3 and sum(held) == 14


def test_short_items_with_changed_words(prose):
    """16 words with every one and every two of them replaced, and a word put in or left out at every place."""
    index, own = index_of([prose(16) for _ in range(30)])
    words = [own.word(k).decode() for k in range(16)]
    texts = []
    for a, b in itertools.combinations_with_replacement(range(16), 2):
        texts.append([w if k not in (a, b) else f"other{k}" for k, w in enumerate(words)])
    for a in range(16):
        texts += [words[:a] + ["put", "in"] + words[a:], words[:a] + words[a + 1:]]
    column = pa.array([" ".join([prose(90), *t, prose(90)]) for t in texts])
    found = index.leaks(Words(column, lower=True))
    assert [r for r in range(len(texts)) if 0 not in found.get(r, {})] == []
    assert all(set(f) == {0} for f in found.values())


def test_words_of_an_item_in_another_order_are_no_leak(prose):
    index, own = index_of([prose(30) for _ in range(30)])
    words = [own.word(k).decode() for k in range(30)]
    texts = []
    for _ in range(50):
        prose.rng.shuffle(words)
        texts.append(" ".join([prose(40), *words, prose(40)]))
    assert not any(index.leaks(Words(pa.array(texts), lower=True)).values())


def test_shares_in_order_equal_a_plain_count(prose):
    rng = np.random.default_rng(4)
    for _ in range(300):
        item = rng.integers(0, 12, rng.integers(1, 20)).astype(np.uint64)
        passage = rng.integers(0, 12, rng.integers(1, 40)).astype(np.uint64)
        cut = int(np.ceil(0.7 * len(item)))
        bands = {}
        for d in range(-len(item) - 3, len(passage) + 3):
            bands[d] = [i for i in range(len(item)) if any(
                0 <= i + d + s < len(passage) and passage[i + d + s] == item[i] for s in range(-decontaminate.SHIFT, 1))]
        most = max(map(len, bands.values()))
        want = {(sum(i < cut for i in b) / cut, sum(i >= cut for i in b) / (len(item) - cut) if len(item) > cut else 1.0)
                for b in bands.values() if len(b) == most}
        got = decontaminate.aligned(item, cut, passage)
        assert got in want or (most == 0 and got == (0.0, 0.0))


def index_of(texts):
    words = Words(pa.array(texts), lower=True)
    df = {}
    for i in range(len(texts)):
        for h in set(words.hash[words.first[i]:words.first[i + 1]].view(np.int64).tolist()):
            df[h] = df.get(h, 0) + 1
    return decontaminate.Index(list(range(len(texts))), texts, df, len(texts), words.count.mean()), words


def test_block_max_wand_finds_all_items_above_the_threshold(prose, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 3)
    index, words = index_of([prose(30) for _ in range(120)])
    rng = np.random.default_rng(2)
    hits = 0
    for _ in range(250):
        i = rng.integers(120)
        own = np.unique(np.searchsorted(index.terms, words.hash[words.first[i]:words.first[i + 1]]))
        terms = np.unique(np.concatenate([rng.choice(own, rng.integers(1, len(own) + 1)),
                                          rng.integers(0, len(index.terms), rng.integers(1, 300))]))
        scores = np.zeros(120)
        for t in terms:
            post = slice(index.start[t], index.start[t + 1])
            scores[index.item[post]] += index.impact[post]
        want = {int(k) for k in np.flatnonzero(scores >= decontaminate.THRESHOLD - 1e-9)}
        got = dict(index.search(terms))
        assert set(got) == want and all(abs(scores[k] - v) < 1e-9 for k, v in got.items())
        hits += len(want)
    assert hits > 100


def test_every_passage_above_the_threshold_passes_the_gate(prose):
    index, _ = index_of([prose(25) for _ in range(60)])
    bag = [prose(1) for _ in range(300)]
    texts = [" ".join(prose.rng.choices(bag, k=150)) for _ in range(60)]
    words = Words(pa.array(texts), lower=True)
    passed = index.windows(words)
    for r in range(words.rows):
        for a in range(words.first[r], words.first[r + 1], index.half):
            b = min(a + 2 * index.half, words.first[r + 1])
            terms = np.flatnonzero(np.isin(index.terms, words.hash[a:b]))
            if index.search(terms):
                assert any(x == r and p <= a and q >= b for x, p, q in passed)


def test_empty_benchmarks_and_documents(spark):
    assert decontaminate.with_leaks(frame(spark, []), benchmark(spark, [(1, "a b c", "x")])).count() == 0
    rows = decontaminate.with_leaks(frame(spark, [(1, "a b c")]), benchmark(spark, [])).collect()
    assert rows[0]["__leaks"] == []


# ---- nearest neighbours


def neighbours(vectors, ids, query_id, q, k):
    scores = [(-(np.array(v) * np.array(q)).sum(), i) for i, v in zip(ids, vectors) if i != query_id]
    return [(i, -s) for s, i in sorted(scores)[:k]]


def test_recall_scores_and_ties(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 24))
    vectors = [(centres[i % 12] * (1 + i % 3) + 0.2 * rng.normal(size=24)).tolist() for i in range(1200)]
    vectors += [vectors[0]] * 60                        # equal vectors: ties
    rows = [(i, v) for i, v in enumerate(vectors)]
    bad = [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [None] * 24), (None, vectors[1]),
           (2080, [1.0, 2.0]), (2100, [float("inf")] + [1.0] * 23), (20, vectors[20])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id long, embedding array<float>, score string")
    got = ann.search(table, F.pmod("vec_id", F.lit(20)) == 0, 10, block_rows=300).collect()
    exact = np.array(vectors, dtype=np.float32).astype(np.float64)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert sorted(by) == list(range(0, 1260, 20))
    hits = total = 0
    for i, own in by.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, -r.vec_id) for r in own] == sorted(((r.score, -r.vec_id) for r in own), reverse=True)
        assert all(abs(r.score - exact[r.vec_id] @ exact[i]) < 1e-9 and r.vec_id != i for r in own)
        want = neighbours(exact, range(len(exact)), i, exact[i], 10)
        hits += len({r.vec_id for r in own} & {x for x, _ in want})
        total += 10
    assert hits / total >= 0.9
    equal = {0, *range(1200, 1260)}
    for own in by.values():                             # of equal vectors the smallest ids, without a gap
        found = [r.vec_id for r in own if r.vec_id in equal]
        assert found == sorted(equal - {own[0].query_id})[:len(found)]


def test_few_candidates_and_empty_tables(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = ann.search(table, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in got] == [(1, 1, 0.5), (2, 2, -1.0)]
    assert ann.search(table.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.search(table.limit(1), F.col("vec_id") == 0).count() == 0


def test_levels_hold_the_share_and_no_longer_prefix_does():
    rng = np.random.default_rng(3)
    forest = ann.Forest(np.arange(800), rng.normal(size=(800, 16)), 10.0)
    codes = forest.codes(rng.normal(size=(20, 16)))
    level = forest.level(codes, 2.0)
    held = lambda lv: np.array([(np.subtract(*forest.ranges(codes, lv)[::-1]))[i].sum() for i in range(20)])
    assert (held(level) >= 1600).all() and (held(np.minimum(level + 1, 64))[level < 64] < 1600).all()
    plain = codes[0][None] ^ forest.codes(forest.vectors, np.sqrt(np.maximum(100 - (forest.vectors**2).sum(axis=1), 0)))
    want = np.flatnonzero((plain < (np.uint64(1) << np.uint64(64 - level[0]))).any(axis=1)) if level[0] else np.arange(800)
    assert (next(forest.candidates(codes, 2.0)) == want).all()


def test_small_tight_groups_and_small_tables_get_all_neighbours(spark):
    rng = np.random.default_rng(5)
    spread = [(100, 0.3)] * 20 + [(10, 0.01)] * 10
    vectors = np.concatenate([rng.normal(size=24) + eps * rng.normal(size=(n, 24)) for n, eps in spread])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids = range(len(vectors))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    by = {}
    for r in ann.search(table, F.pmod("vec_id", F.lit(10)) == 0).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    assert sorted(by) == list(range(0, 2100, 10)) and {len(x) for x in by.values()} == {20}
    small = [len(by[i] & {x for x, _ in neighbours(vectors, ids, i, vectors[i], 20)}) for i in by if i >= 2000]
    assert np.mean(small) >= 18
    few = [(i, vectors[100 * i].tolist()) for i in range(15)] + [(15 + i, vectors[2000 + i].tolist()) for i in range(4)]
    got = ann.search(spark.createDataFrame(few, "vec_id long, embedding array<double>"), F.lit(True)).collect()
    assert {(r.query_id, r.vec_id) for r in got} == {(a, b) for a in range(19) for b in range(19) if a != b}


def test_a_query_with_many_vectors_under_its_id(spark):
    rows = [(0, [1.0, 0.01 * i]) for i in range(30)] + [(i, [0.5, 0.02 * i]) for i in range(1, 26)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(table, F.col("vec_id") == 0).groupBy("query_id").count().collect()
    assert [tuple(r) for r in got] == [(0, 600)]


# ---- SentencePiece


@pytest.fixture(scope="module")
def vocabulary():
    return sentence_pieces.Vocabulary.load()


def all_paths(v, chunk):
    if chunk == sentence_pieces.LITERAL:
        return [(v.fallback, tuple(v.byte_ids[b] for b in "▁".encode()))]
    edges = list(v.edges(chunk))

    def go(a):
        if a == len(chunk):
            return [(0.0, ())]
        return [(s + t, i + j) for x, y, i, s in edges if x == a for t, j in go(y)]
    return go(0)


@pytest.mark.parametrize("text", ["the", "hello an", "b é▁x", "漢 ab", "  two", "a\nb", "▁", "", " ", "thing and", "\tx", "▁▁ a", "aaaaaaaa"])
def test_n_best_equal_all_segmentations(vocabulary, text):
    n = 6
    encoder = sentence_pieces.Encoder(vocabulary, n)
    (ids, score, others), = encoder.encode([text])
    paths = sorted((sum(s for s, _ in p) for p in itertools.product(*[all_paths(vocabulary, c) for c in encoder.split(text)])),
                   reverse=True)[:n]
    assert np.allclose([score] + [s for s, _ in others], paths if text else [0.0])
    seen = {tuple(ids.tolist())}
    for _, edits in others:
        own = ids.tolist()
        for at, size, new in sorted(edits, reverse=True):
            own[at:at + size] = new
        assert sentence_pieces.decode(vocabulary.table, own) == text
        seen.add(tuple(own))
    assert len(seen) == 1 + len(others)


def test_vectorised_and_scalar_passes_agree(vocabulary, prose):
    words = {"▁" + w for w in prose(400).split(" ")} | {"▁" + "".join(prose(6).split(" "))[:39]}
    words = {w for w in words if not any(vocabulary.without_piece[ord(c)] for c in w)}
    encoder = sentence_pieces.Encoder(vocabulary)
    encoder.learn(set(list(words)[::2]))
    encoder.learn(words)
    assert encoder.known.keys() == words
    for w in words:
        ids, score, gap = encoder._scalar(w)
        k = encoder.known[w]
        assert (encoder.score[k], encoder.gap[k]) == (score, gap)
        assert encoder.ids[encoder.first[k]:encoder.first[k] + encoder.size[k]].tolist() == ids.tolist()


def test_what_is_forgotten_is_learned_again(vocabulary, prose, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "REMEMBERED", 20)
    texts = [prose(60) for _ in range(12)]
    encoder = sentence_pieces.Encoder(vocabulary)
    for t in texts + texts:
        (ids, score, _), = encoder.encode([t])
        (again, other, _), = sentence_pieces.Encoder(vocabulary).encode([t])
        assert ids.tolist() == again.tolist() and score == other


def test_round_trip_of_odd_texts(spark, vocabulary, prose, odd):
    texts = odd + [(i, t) for i, t in enumerate(["▁", "x▁ ▁y", "\u0000a", "é" * 50, prose(3000), "a" * 5000, "😀 漢字\r\n", " x "])]
    docs = frame(spark, texts)
    rows = sentence_pieces.encoded(docs, vocabulary).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["__decoded"] == (r.text or "") and (len(r["__ids"]) > 0) == bool(r.text)
        assert all(p.score <= r["__piece_score"] for p in r["__paths"])
    again = sentence_pieces.decoded(sentence_pieces.encoded(docs, vocabulary).select("text", "__ids"), vocabulary, "__ids", "d")
    assert all(r.d == (r.text or "") for r in again.collect())
    assert sentence_pieces.encoded(frame(spark, []), vocabulary).count() == 0


def test_each_length_is_searched_among_its_own(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4 if i % 3 else 3).tolist()) for i in range(90)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(table, F.lit(True), 5).collect()
    met = 0
    for i, v in rows:
        near = {j for _, j in sorted((-float(np.dot(v, w)), j) for j, w in rows if j != i and len(w) == len(v))[:5]}
        own = [r.vec_id for r in got if r.query_id == i]
        assert len(own) == 5 and all(len(rows[j][1]) == len(v) for j in own)
        met += len(near & set(own))
    assert met >= 0.9 * 5 * len(rows)


def test_single_precision_only_preselects():
    rng = np.random.default_rng(4)
    for scale in (1.0, 1e18, 1e-14):
        vectors = rng.normal(size=(3000, 8)) * scale
        vectors[100:200] = vectors[100] * (1 + 1e-9 * np.arange(100)[:, None])
        forest = ann.Forest(np.arange(3000), vectors, float(np.sqrt((vectors**2).sum(axis=1).max())))
        q = vectors[100]
        keep, scores = forest.top(np.arange(len(forest.vectors)), q, 20)
        best = np.sort((forest.vectors * q).sum(axis=1))[-20:]
        assert np.array_equal(np.sort(scores)[-20:], best)


@pytest.mark.parametrize("text", ["-" * 100_000, "ab" * 30_000, " " * 50_000, "- " * 20_000])
def test_long_runs_take_seconds(vocabulary, text):
    from time import perf_counter
    t = perf_counter()
    (ids, score, more), = sentence_pieces.Encoder(vocabulary).encode([text])
    assert perf_counter() - t < 30 and sentence_pieces.decode(vocabulary.table, ids.tolist()) == text
    assert all(s <= score + 1e-6 for s, _ in more)


def test_added_columns_must_be_new(spark, vocabulary):
    docs = spark.createDataFrame([(1, "a", "x", "y")], "doc_id long, text string, __lang string, __ids string")
    with pytest.raises(ValueError, match="__lang"):
        language_id.with_language(docs, language_id.fit([]))
    with pytest.raises(ValueError, match="__ids"):
        sentence_pieces.encoded(docs, vocabulary)


def test_clean_texts_are_not_undecided():
    model = language_id.fit([("aa", "the cat sat on the mat and the dog " * 8), ("bb", "le chat est sur la table avec le chien " * 8)] * 40)
    assert language_id.undecided(model) == language_id.CHANCE / 2 and language_id.undecided(language_id.fit([])) == 0.0
    import pyarrow as pa
    langs, scores = language_id.classify(pa.array(["the dog sat on the cat", "la table est avec le chat", "123"]), model)
    assert langs == ["aa", "bb", "und"] and (scores[:2] > language_id.undecided(model)).all()


def test_decoding_all_texts_at_once(vocabulary, prose, odd):
    texts = [t or "" for _, t in odd] + [prose(200), "▁ \U0001F600\x00 é", "", " lead", "日本語 text"]
    rows = [r[0] for r in sentence_pieces.Encoder(vocabulary).encode(texts)]
    sizes = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    assert sentence_pieces.decode_all(vocabulary, np.concatenate(rows), sizes).to_pylist() == texts
    assert [sentence_pieces.decode(vocabulary.table, r.tolist()) for r in rows] == texts
