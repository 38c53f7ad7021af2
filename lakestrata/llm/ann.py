"""Approximate nearest neighbours (largest inner product) with a hash-prefix forest.

Vectors are dealt out to blocks of bounded size.  A block holds, per tree,
the sorted array of its vectors' 64-bit hash strings (signs of random
projections; an extra coordinate levels the norms, so that angle order is
inner-product order).  A query descends every tree of every block to its
longest prefix and ascends all trees at the same pace until the prefix ranges
hold a share of the block, and on until the union has k entries and would have met
one as near as the last of them; the union of the ranges is scored exactly and the
best of all blocks are merged.  The share is set from a bounded sample of queries
whose true neighbours a scan finds: the least share that recalls
``RECALL`` of them, so that easy data touch few rows and hard data many.

Cases: null, zero or non-finite vectors, vectors holding nulls and rows
without an id take no part; vectors of several lengths are searched each among
those of its own length; equal vectors are one
entry with many ids; equal scores go to the smaller id; rows repeating id and
vector count once; a candidate with the query's id is the query's own row;
with too few candidates all are returned; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .memory import lean

NEIGHBOURS = 20
TREES = 64
BITS = 64
BLOCK_ROWS = 1 << 14
BATCH = 256                 # queries handled at once
SAMPLE = 128                # queries that set the share
RECALL = 0.95               # of the sample's true neighbours; the contract asks for 0.9
LEAST_RECALL = 0.9          # of each query's last neighbour, by the chance that a tree's prefix meets it
SEED = 11
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
FOUND = "query_id long, q long, vec_id long, score double"


class Forest:
    """The trees over one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top_norm: float) -> None:
        flat = np.ascontiguousarray(vectors + 0.0).view([("", vectors.dtype)] * vectors.shape[1]).ravel()
        _, first, group = np.unique(flat, return_index=True, return_inverse=True)
        self.vectors, self.top_norm = vectors[first], top_norm
        order = np.lexsort((ids, group.ravel()))
        self.ids = ids[order]                               # grouped by vector, ascending
        self.by_id = np.sort(ids)
        self.norm = float(np.sqrt((self.vectors**2).sum(axis=1).max(initial=0)))
        self.single = self.vectors.astype(np.float32)       # for a first, rough product
        self.start = np.concatenate([[0], np.cumsum(np.bincount(group.ravel(), minlength=len(first)))])
        rng = np.random.default_rng(SEED)
        self.planes = rng.standard_normal((vectors.shape[1] + 1, TREES * BITS)).astype(np.float32)
        lift = np.sqrt(np.maximum(top_norm**2 - (self.vectors**2).sum(axis=1), 0))
        codes = self.codes(self.vectors, lift)
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(codes, self.order, axis=0).T)
        self.order = np.ascontiguousarray(self.order.T)

    def codes(self, vectors: np.ndarray, lift: np.ndarray | float = 0.0) -> np.ndarray:
        """(row, tree) hash strings as 64-bit numbers."""
        lifted = np.column_stack([vectors, np.broadcast_to(lift, len(vectors))]).astype(np.float32)
        out = [np.packbits(lifted[i:i + 512] @ self.planes > 0, axis=1).view(">u8").astype(np.uint64)
               for i in range(0, len(lifted), 512)]
        return np.concatenate(out) if out else np.zeros((0, TREES), dtype=np.uint64)

    def ranges(self, codes: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree, the sorted array's range that shares the query's first ``level`` bits."""
        rest = np.where(level <= 0, FULL, np.where(
            level >= BITS, np.uint64(0), FULL >> np.clip(level, 1, BITS - 1).astype(np.uint64)))[:, None]
        low, high = codes & ~rest, codes | rest
        lo, hi = np.empty(codes.shape, np.int64), np.empty(codes.shape, np.int64)
        for t in range(TREES):
            lo[:, t] = np.searchsorted(self.sorted[t], low[:, t], "left")
            hi[:, t] = np.searchsorted(self.sorted[t], high[:, t], "right")
        return lo, hi

    def level(self, codes: np.ndarray, share: float) -> np.ndarray:
        """The longest prefix at which all trees together hold ``share`` times the block's vectors."""
        need = share * len(self.vectors)
        low, high = np.zeros(len(codes), np.int64), np.full(len(codes), BITS + 1)
        while (high - low > 1).any():                       # ranges only grow on the way up
            mid = (low + high) // 2
            lo, hi = self.ranges(codes, mid)
            enough = (hi - lo).sum(axis=1) >= need
            low, high = np.where(enough, mid, low), np.where(enough, high, np.maximum(mid, low + 1))
        return low

    def united(self, codes: np.ndarray, level: np.ndarray) -> Iterator[np.ndarray]:
        """Per query, the rows in any tree's range at a level."""
        lo, hi = self.ranges(codes, level)
        seen = np.zeros(len(self.vectors), dtype=bool)
        for a, b in zip(lo, hi):
            seen[:] = False
            for t in range(TREES):
                seen[self.order[t, a[t]:b[t]]] = True
            yield np.flatnonzero(seen)

    def candidates(self, codes: np.ndarray, share: float) -> Iterator[np.ndarray]:
        return self.united(codes, self.level(codes, share))

    def enough(self, q: np.ndarray, scores: np.ndarray, level: int, k: int) -> bool:
        """Whether k were found and a vector as near as the last of them is met at this level with ``LEAST_RECALL``."""
        if len(scores) < k:
            return False
        cosine = scores[-1] / (np.sqrt((q**2).sum()) * self.top_norm)
        same = 1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi        # chance of a bit
        return (1 - same**level) ** TREES <= 1 - LEAST_RECALL

    def nearest(self, ids: np.ndarray, vectors: np.ndarray, share: float, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the k best found for each query.

        A vector counts for the share once in each tree, so a small tight group
        can fill it alone: from there a query ascends until it has ``enough``,
        at most to the whole block.
        """
        codes = self.codes(vectors)
        at = self.level(codes, share)
        seen = np.zeros((len(ids), len(self.vectors)), dtype=bool)
        out = [(np.zeros(0, np.int64), np.zeros(0))] * len(ids)
        left = np.arange(len(ids))
        while len(left):
            more = []
            lo, hi = self.ranges(codes[left], at[left])
            for i, a, b in zip(left, lo, hi):
                out[i] = self.better(out[i], ids[i], vectors[i], self.fresh(seen[i], a, b), k)
                if at[i] > 0 and not self.enough(vectors[i], out[i][1], at[i], k):
                    more.append(i)
            left = np.array(more, dtype=np.int64)
            at[left] -= 1
        yield from out

    def fresh(self, seen: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Rows in the trees' ranges that were not seen yet; they are now."""
        before = seen.copy()
        for t in range(TREES):
            seen[self.order[t, lo[t]:hi[t]]] = True
        return np.flatnonzero(seen & ~before)

    def better(self, have: tuple[np.ndarray, np.ndarray], query_id: int, q: np.ndarray, rows: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of those found so far and of some rows that were not looked at."""
        if not len(rows):
            return have
        new = self.best(query_id, q, rows, k)
        ids, scores = np.concatenate([have[0], new[0]]), np.concatenate([have[1], new[1]])
        keep = np.lexsort((ids, -scores))[:k]
        return ids[keep], scores[keep]

    def top(self, rows: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``rows`` that may be among the k best, and their scores.

        A product in single precision preselects: its error is below the slack, which
        follows from the vectors' norms; where they are out of its range all are kept.
        """
        keep, most = np.arange(len(rows)), self.norm * float(np.sqrt((q**2).sum()))
        if len(rows) > 4 * k and 1e-20 < most < 1e30:
            rough = self.single[rows] @ q.astype(np.float32)
            cut = np.partition(rough, len(rough) - k)[len(rough) - k]
            keep = np.flatnonzero(rough >= cut - 4e-7 * (len(q) + 4) * most)
        near, scores = top(self.vectors[rows[keep]], q, k)
        return keep[near], scores

    def needed(self, code: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Per row, the least share at which the query's candidates hold it."""
        lcp = np.zeros(len(rows), np.int64)
        for t in range(TREES):
            place = np.empty(len(self.vectors), np.int64)
            place[self.order[t]] = np.arange(len(self.vectors))
            differ = self.sorted[t][place[rows]] ^ code[t]
            bits = np.array([BITS - int(x).bit_length() for x in differ])
            lcp = np.maximum(lcp, bits)
        lo, hi = self.ranges(np.repeat(code[None], len(rows), axis=0), np.minimum(lcp + 1, BITS))
        count = np.where(lcp >= BITS, 0, (hi - lo).sum(axis=1))
        return (count + 1) / len(self.vectors)

    def best(self, query_id: int, q: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best of some rows, in double precision."""
        own = np.searchsorted(self.by_id, query_id, "right") - np.searchsorted(self.by_id, query_id, "left")
        ids, scores = self.top(rows, q, k + max(1, int(own)))
        out_ids, out_scores = [], []
        for r, s in zip(rows[ids], scores):
            own = self.ids[self.start[r]:self.start[r + 1]][:k + 1]
            own = own[own != query_id]
            out_ids.append(own)
            out_scores.append(np.full(len(own), s))
        if not out_ids:
            return np.zeros(0, np.int64), np.zeros(0)
        i, s = np.concatenate(out_ids), np.concatenate(out_scores)
        keep = np.lexsort((i, -s))[:k]
        return i[keep], s[keep]


def top(vectors: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may be among the k best and their scores.

    The product is summed row by row in one fixed order, so equal vectors have
    equal scores wherever they are; a matrix product only preselects.
    """
    rough = vectors @ q
    if len(rough) > k:
        cut = np.partition(rough, len(rough) - k)[len(rough) - k]
        slack = 1e-9 * (1 + np.abs(rough).max())
        keep = np.flatnonzero(rough >= cut - slack)
    else:
        keep = np.arange(len(rough))
    return keep, (vectors[keep] * q).sum(axis=1)


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v, q): ids, vectors in double precision and a key of the pair; repeated rows once."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).filter(F.exists("v", lambda x: x != 0.0))
    return rows.select("vec_id", "v", F.xxhash64("vec_id", "v").alias("q")).dropDuplicates(["vec_id", "q"])


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def true_neighbours(rows: DataFrame, queries: list, size: int, k: int) -> DataFrame:
    """Brute force for a bounded list of queries: one scan, k rows a batch and query."""
    wanted = [(r.vec_id, r.q, np.array(r.v)) for r in queries]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vectors = batch.column(0).to_numpy(), matrix(batch.column(1), size)
            for query_id, key, q in wanted:
                keep, scores = top(vectors, q, k + 1 + int((ids == query_id).sum()))
                order = [i for i in np.lexsort((ids[keep], -scores)) if ids[keep[i]] != query_id][:k]
                yield found(query_id, key, ids[keep[order]], scores[order])

    return best_of(rows.select("vec_id", "v").mapInArrow(scan, FOUND), k)


def found(query_id: int, key: int, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays([pa.array([query_id] * n, pa.int64()), pa.array([key] * n, pa.int64()),
                                       pa.array(ids, pa.int64()), pa.array(scores, pa.float64())],
                                      names=["query_id", "q", "vec_id", "score"])


def best_of(rows: DataFrame, k: int) -> DataFrame:
    """The k best of each query: a query has at most k rows a block here."""
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def blocks(rows: DataFrame, is_query: Column, n_blocks: int) -> DataFrame:
    """Vectors dealt to blocks by hash, then every query once for each block: a block is a partition, its vectors come first."""
    own = rows.select(F.pmod("q", F.lit(n_blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "v", "q")
    asked = rows.filter(is_query).select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
                                         F.lit(1).alias("kind"), "vec_id", "v", "q")
    return own.unionByName(asked).repartitionById(n_blocks, "block").sortWithinPartitions("block", "kind")


def by_block(batches: Iterator[pa.RecordBatch], size: int, top_norm: float) -> Iterator[tuple]:
    """(forest, query ids, keys, vectors) for the batches of queries of each block in a partition."""
    block, held, forest = None, [], None
    for batch in batches:
        numbers, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            if a == b:
                continue
            if numbers[a] != block:
                block, held, forest = numbers[a], [], None
            part = batch.slice(a, b - a)
            ids, vectors, keys = part.column(2).to_numpy(), matrix(part.column(3), size), part.column(4).to_numpy()
            if kinds[a] == 0:
                held.append((ids, vectors))
                continue
            if forest is None and held:
                forest = Forest(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]), top_norm)
                held = []
            if forest is not None:
                for i in range(0, len(ids), BATCH):
                    yield forest, ids[i:i + BATCH], keys[i:i + BATCH], vectors[i:i + BATCH]


def share_needed(rows: DataFrame, queries: list, truth: list, size: int, top_norm: float, n_blocks: int,
                 recall: float) -> float:
    """The least share that finds ``recall`` of the sample's true neighbours."""
    wanted: dict[int, set[int]] = {}
    for r in truth:
        wanted.setdefault(r.q, set()).add(r.vec_id)
    keys = {r.q for r in queries}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for forest, _, q_keys, vectors in by_block(batches, size, top_norm):
            entry = np.repeat(np.arange(len(forest.vectors)), np.diff(forest.start))
            out = []
            for key, code in zip(q_keys, forest.codes(vectors)):
                here = np.flatnonzero(np.isin(forest.ids, list(wanted.get(key, ()))))
                if len(here):
                    out.append(forest.needed(code, entry[here]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["share"])

    is_sample = F.col("q").isin(list(keys))
    shares = [r.share for r in blocks(rows, is_sample, n_blocks).mapInArrow(measure, "share double").collect()]
    return float(np.quantile(shares, recall, method="higher")) if shares else 0.0      # at most SAMPLE * k numbers


def search(table: DataFrame, is_query: Column, k: int = NEIGHBOURS, id_col: str = "vec_id",
           vector_col: str = "embedding", recall: float = RECALL, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for the rows for which ``is_query`` (over ``vec_id``) holds."""
    rows = usable(table, id_col, vector_col)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    lengths = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("norm")).collect()
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for r in sorted(lengths):                               # one search a length
        out = out.unionByName(_search(rows.filter(F.size("v") == r["size"]), is_query, k, recall,
                                      max(1, -(-r["n"] // block_rows)), r["size"], r["norm"]))
    return out


def _search(rows: DataFrame, is_query: Column, k: int, recall: float, n_blocks: int, size: int, top_norm: float) -> DataFrame:
    """The search among vectors of one length."""
    sample = rows.filter(is_query).orderBy(F.xxhash64("q", F.lit("sample")), "q").limit(SAMPLE).collect()
    truth = true_neighbours(rows, sample, size, k).select("q", "vec_id").collect()      # SAMPLE * k rows
    share = share_needed(rows, sample, truth, size, top_norm, n_blocks, recall)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for forest, ids, keys, vectors in by_block(batches, size, top_norm):
            for i, best in enumerate(forest.nearest(ids, vectors, share, k)):
                yield found(ids[i], keys[i], *best)

    hits = blocks(rows, is_query, n_blocks).mapInArrow(lean(ask), FOUND)
    return best_of(hits, k).select("query_id", "rank", "vec_id", "score")
