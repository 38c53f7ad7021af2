"""Benchmark decontamination: BM25 over the test items with block-max WAND, then an overlap check.

The test items are the indexed side: an inverted index with BM25 impacts, each
divided by the item's score against itself, and block maxima.  Every passage of
every document (half-overlapping windows, twice as long as the longest item, so that
an item always lies inside one) is a query; all items with a score of at least
``THRESHOLD`` are retrieved.  Terms whose joint share of an item stays below
half the threshold are non-essential: a vectorised pass over the essential
ones finds the passages that can reach the threshold at all, and only these
enter the search.  A hit counts if the passage holds enough of the n-grams of
the item's question (the first part of its words) and of its answer (the rest),
or nearly all of the question.  A few changed words break most n-grams of a short
item; so a hit also counts if the words of question and answer stand in the passage
one by one, in the item's order and about as far apart (``aligned``).

The index goes to the tasks in shards of about ``SHARD_BYTES`` of item text, one after
the other: the driver never holds more than two.  Every further shard is one more
pass over the documents.

Cases: null and empty texts and items match nothing; parts shorter than an
n-gram must occur as a whole; items of fewer than ``EDIT_LEAST`` words must hold by
their n-grams; equal items are all reported; repeated rows and
null ids are handled row by row; empty tables give no leaks; columns pass.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .keys import added, free
from .memory import lean
from .wordhash import Words, slices

K1, B = 0.9, 0.4
THRESHOLD = 0.4             # of an item's score against itself
QUESTION = 0.7              # of an item's words; the rest is the answer
NGRAM = 5
OVERLAP = 0.5               # of question and of answer
ALONE = 0.8                 # of the question, whatever the answer
EDITED = 0.75               # of the question's words, in order, beside OVERLAP of the answer's
EDIT_LEAST = 8              # words of an item that may be found by its words in order
SHIFT = 2                   # words put in or left out between the item's words
LEAST_WINDOW = 64           # words
BLOCK = 32                  # postings under one block maximum
SHARD_BYTES = 16 << 20

LEAK = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
                     T.StructField("question", T.DoubleType()), T.StructField("answer", T.DoubleType())])
_LEAK = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()),
                   ("answer", pa.float64())])


class Index:
    """Postings of a shard's items, by hashed term; impacts are shares of the item's own score."""

    def __init__(self, ids: list[int | None], texts: list[str], df: dict[int, int], n_items: int, mean: float) -> None:
        words = Words(pa.array(texts, pa.string()), lower=True)
        self.ids = ids
        self.terms = np.unique(words.hash)
        n = len(ids)
        row = words.row()
        pair, tf = np.unique(np.searchsorted(self.terms, words.hash) * n + row, return_counts=True)
        term, item = pair // n, pair % n
        count = np.array([df[int(h)] for h in self.terms.view(np.int64)], dtype=float)
        idf = np.log1p((n_items - count + 0.5) / (count + 0.5))
        norm = K1 * (1 - B + B * words.count / max(mean, 1.0))
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[item])
        impact /= np.bincount(item, impact, n)[item]
        self.item, self.impact = item, impact
        self.start = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.most = np.maximum.reduceat(impact, self.start[:-1]) if len(term) else np.zeros(0)
        #: block maxima and last items, a list for each term
        self.blocks = []
        for a, b in zip(self.start[:-1], self.start[1:]):
            edge = np.arange(a, b, BLOCK)
            self.blocks.append((np.maximum.reduceat(impact, edge).tolist(),
                                item[np.minimum(edge + BLOCK, b) - 1].tolist()))
        # non-essential terms, the most frequent first, while their share of every item stays below half the threshold
        self.essential = np.ones(len(self.terms), dtype=bool)
        self.rest = np.zeros(n)
        for t in np.argsort(-np.diff(self.start), kind="stable"):
            own = slice(self.start[t], self.start[t + 1])
            if (self.rest[item[own]] + impact[own]).max(initial=0.0) > THRESHOLD / 2:
                continue
            self.rest[item[own]] += impact[own]
            self.essential[t] = False
        cut = np.ceil(QUESTION * words.count).astype(int)
        runs = words.runs()
        self.parts = [[grams(runs, words.first[i], words.first[i] + cut[i]),
                       grams(runs, words.first[i] + cut[i], words.first[i + 1])] for i in range(n)]
        self.words = [(words.hash[words.first[i]:words.first[i + 1]], int(cut[i])) for i in range(n)]
        self.half = max(LEAST_WINDOW // 2, int(words.count.max(initial=0)))

    def search(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """Block-max WAND: all items that reach the threshold for a set of distinct terms."""
        limit = THRESHOLD - 1e-9
        lists = [(self.item[a:b].tolist(), self.impact[a:b].tolist(), *self.blocks[t], float(self.most[t]))
                 for t in terms for a, b in [(self.start[t], self.start[t + 1])]]
        at = [0] * len(lists)
        live = list(range(len(lists)))
        out = []

        def seek(c: int, item: int) -> None:
            items, _, _, last, _ = lists[c]
            p = at[c]
            while p < len(items) and last[p // BLOCK] < item:        # skip whole blocks
                p = (p // BLOCK + 1) * BLOCK
            while p < len(items) and items[p] < item:
                p += 1
            at[c] = min(p, len(items))

        while True:
            live = sorted((c for c in live if at[c] < len(lists[c][0])), key=lambda c: lists[c][0][at[c]])
            bound, pivot = 0.0, None
            for k, c in enumerate(live):
                bound += lists[c][4]
                if bound >= limit:
                    pivot = k
                    break
            if pivot is None:
                return out
            item = lists[live[pivot]][0][at[live[pivot]]]
            while pivot + 1 < len(live) and lists[live[pivot + 1]][0][at[live[pivot + 1]]] == item:
                pivot += 1
            block_bound, ends = 0.0, []
            for c in live[:pivot + 1]:
                _, _, maxima, last, _ = lists[c]
                b = at[c] // BLOCK
                while b < len(last) and last[b] < item:               # shallow move
                    b += 1
                if b < len(last):
                    block_bound += maxima[b]
                    ends.append(last[b] + 1)
            if block_bound < limit:
                after = lists[live[pivot + 1]][0][at[live[pivot + 1]]] if pivot + 1 < len(live) else None
                goal = min([*ends, *([after] if after is not None else [])], default=item + 1)
                for c in live[:pivot + 1]:
                    seek(c, max(goal, item + 1))
            elif lists[live[0]][0][at[live[0]]] == item:
                score = sum(lists[c][1][at[c]] for c in live[:pivot + 1])
                if score >= limit:
                    out.append((item, score))
                for c in live[:pivot + 1]:
                    at[c] += 1
            else:
                for c in live[:pivot + 1]:
                    seek(c, item)

    def windows(self, words: Words) -> list[tuple[int, int, int]]:
        """(row, first word, end) of the passages that can reach the threshold.

        Half windows are summed one by one; a passage is two neighbours.
        """
        term = np.searchsorted(self.terms, words.hash)
        term[term == len(self.terms)] = 0
        known = np.flatnonzero((self.terms[term] == words.hash) & self.essential[term]) if len(self.terms) else []
        if not len(known):
            return []
        row = words.row()
        halves = -(-words.count // self.half)
        first_half = np.concatenate([[0], np.cumsum(halves)])
        half = first_half[row[known]] + (known - words.first[row[known]]) // self.half
        pair = np.unique(half * len(self.terms) + term[known])
        half, term = pair // len(self.terms), pair % len(self.terms)
        n = np.diff(self.start)[term]
        post = np.repeat(self.start[term] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        key = np.repeat(half, n) * len(self.ids) + self.item[post]
        order = np.argsort(key, kind="stable")
        key = key[order]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        total, key = np.add.reduceat(self.impact[post][order], edge), key[edge]
        after = np.searchsorted(key, key + len(self.ids))
        found = (after < len(key)) & (key[np.minimum(after, len(key) - 1)] == key + len(self.ids))
        h = key // len(self.ids)
        text = np.searchsorted(first_half, np.arange(first_half[-1]), side="right") - 1
        same = found & (text[np.minimum(h + 1, len(text) - 1)] == text[h])
        both = total + np.where(same, total[np.minimum(after, len(key) - 1)], 0.0)
        hit = np.unique(h[both >= (THRESHOLD - 1e-9 - self.rest)[key % len(self.ids)]])
        out = []
        for x in hit.tolist():
            r = int(text[x])
            a = int(words.first[r] + (x - first_half[r]) * self.half)
            # the neighbours of a half on both sides: a passage may also end with it
            out.append((r, max(int(words.first[r]), a - self.half), min(int(words.first[r + 1]), a + 2 * self.half)))
        return out

    def leaks(self, words: Words) -> dict[int, dict[int, tuple[float, float, float]]]:
        """By row and item: best score and overlaps over the row's passages."""
        runs = words.runs()
        out: dict[int, dict[int, tuple]] = defaultdict(dict)
        for row, a, b in self.windows(words):
            place = np.searchsorted(self.terms, words.hash[a:b])
            place = place[place < len(self.terms)]
            held = np.unique(place[np.isin(self.terms[place], words.hash[a:b])])
            for item, score in self.search(held):
                shares = []
                for size, wanted in self.parts[item]:
                    own = runs(np.arange(a, b - size + 1), np.arange(a, b - size + 1) + size) if b - a >= size else []
                    shares.append(float(np.isin(wanted, own).mean()) if len(wanted) else 1.0)
                kept = min(shares) >= OVERLAP or shares[0] >= ALONE
                if not kept and len(self.words[item][0]) >= EDIT_LEAST:
                    shares = aligned(*self.words[item], words.hash[a:b])
                    kept = shares[0] >= EDITED and shares[1] >= OVERLAP
                if kept and score > out[row].get(item, (-1.0,))[0]:
                    out[row][item] = (score, *shares)
        return out


def aligned(item: np.ndarray, cut: int, passage: np.ndarray) -> tuple[float, float]:
    """Shares of the item's question (its first ``cut`` words) and of its answer that stand in the passage in order.

    A word at ``i`` in the item and ``j`` in the passage lies on the diagonal ``j - i``; a replaced word
    leaves the others on theirs, one put in or left out moves the rest by one.  Of all bands of ``SHIFT`` + 1
    neighbouring diagonals the one with most words of the item counts.
    """
    order = np.argsort(passage, kind="stable")
    low = np.searchsorted(passage, item, side="left", sorter=order)
    n = np.searchsorted(passage, item, side="right", sorter=order) - low
    if not n.sum():
        return 0.0, 0.0
    i = np.repeat(np.arange(len(item)), n)
    j = order[np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(i))]
    band = (j - i + len(item))[:, None] + np.arange(SHIFT + 1)
    pair = np.unique(band * len(item) + i[:, None])
    band, i = pair // len(item), pair % len(item)
    best = np.argmax(np.bincount(band))
    asked = np.count_nonzero(i[band == best] < cut)
    answered = np.count_nonzero(band == best) - asked
    return asked / cut, answered / (len(item) - cut) if len(item) > cut else 1.0


def grams(runs, a: int, b: int) -> tuple[int, np.ndarray]:
    """(words in an n-gram, hashes) of a part; a part shorter than an n-gram is one."""
    size = min(NGRAM, int(b - a))
    if size == 0:
        return 0, np.zeros(0, np.uint64)
    at = np.arange(a, b - size + 1)
    return size, np.unique(runs(at, at + size))


def shards(benchmark: DataFrame, id_col: str, text_col: str, shard_bytes: int) -> Iterator[Index]:
    """Indexes over all items, each of bounded size, one after the other; term statistics are those of all items.

    Items and term counts are tables; with more than one shard they are written by shard, so that the driver reads
    and holds one shard at a time.
    """
    items = benchmark.select(F.col(id_col).cast("long").alias("id"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n_words = F.size(F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != ""))
    size, n_items, mean = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1)), F.avg(n_words)).first()
    if not n_items:
        return
    n = -(-size // shard_bytes) or 1

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(0), lower=True)
            pair = np.unique(np.stack([words.row().astype(np.uint64), words.hash]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pair[1].view(np.int64)),
                                              pa.array(np.repeat(batch.column(1).to_numpy(), np.bincount(
                                                  pair[0].astype(np.int64), minlength=batch.num_rows)))],
                                             names=["term", "shard"])

    items = items.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int"))
    own = items.select("text", "shard").mapInArrow(lean(terms), "term long, shard int").groupBy("term", "shard").agg(
        F.count(F.lit(1)).alias("n"))
    counts = own.join(own.groupBy("term").agg(F.sum("n").alias("df")), "term") if n > 1 else own.withColumnRenamed("n", "df")
    if n > 1:
        spark, folder = benchmark.sparkSession, scratch_path(benchmark.sparkSession, "benchmark")
        items.write.partitionBy("shard").parquet(f"{folder}/items")
        counts.select("shard", "term", "df").write.partitionBy("shard").parquet(f"{folder}/terms")
        items, counts = spark.read.parquet(f"{folder}/items"), spark.read.parquet(f"{folder}/terms")
    for s in range(n):
        rows = items.filter(F.col("shard") == s).orderBy("id", "text").collect()     # about shard_bytes
        if rows:
            df = {r.term: r.df for r in counts.filter(F.col("shard") == s).select("term", "df").collect()}
            yield Index([r.id for r in rows], [r.text for r in rows], df, n_items, mean)


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", out: str = "__leaks", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` and an array of its leaked items: (item_id, score, question, answer).

    With one shard, a pass over ``docs`` finds them.  With more, each shard is built, sent to the tasks, and its
    pass over the texts written to the shared folder before the next one; leaks come back to the rows by the
    hash of the text, on which alone they depend.
    """
    added(docs, out)
    indexes = shards(benchmark, item_col, item_text_col, shard_bytes)
    first, second = next(indexes, None), next(indexes, None)
    none = F.array().cast(T.ArrayType(LEAK))
    if first is None:
        return docs.withColumn(out, none)
    if second is None:
        return _scan(docs, first, text_col, out)
    folder = scratch_path(docs.sparkSession, "leaks")
    texts = docs.select(F.col(text_col).alias("text")).filter(F.length("text") > 0)
    for k, index in enumerate(chain([first, second], indexes)):
        first = second = None
        found = _scan(texts, index, "text", "leaks").filter(leaked("leaks"))
        found.groupBy(F.sha2("text", 256).alias("hash")).agg(F.first("leaks").alias("leaks")).write.parquet(f"{folder}/{k}")
    found = docs.sparkSession.read.parquet(*[f"{folder}/{i}" for i in range(k + 1)])
    hash_, = free(docs, "text_hash")
    found = found.select(F.col("hash").alias(hash_), F.explode("leaks").alias("leak")).groupBy(hash_).agg(
        F.array_sort(F.collect_list("leak")).alias(out))
    back = docs.withColumn(hash_, F.sha2(F.col(text_col), 256)).join(found, hash_, "left")
    return back.select(*docs.columns, F.coalesce(out, none).alias(out))


def _scan(docs: DataFrame, index: Index, text_col: str, out: str) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(LEAK))])
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = batch.set_column(place, batch.schema.names[place], batch.column(place).fill_null(""))
            done = 0
            for part in slices(full, full.schema.names[place]):
                leaks = index.leaks(Words(part.column(place), lower=True))
                own = batch.slice(done, part.num_rows)
                done += part.num_rows
                column = pa.array([[{"item_id": index.ids[i], "score": s, "question": q, "answer": a}
                                    for i, (s, q, a) in sorted(leaks.get(r, {}).items())]
                                   for r in range(part.num_rows)], pa.list_(_LEAK))
                yield pa.RecordBatch.from_arrays([*own.columns, column], names=schema.names)

    return docs.mapInArrow(lean(run), schema)


def leaked(column: str = "__leaks") -> Column:
    return F.size(column) > 0
