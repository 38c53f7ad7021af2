"""N-best segmentation into the pieces of a public SentencePiece vocabulary, and back.

A text's piece lattice falls into chunks that no piece crosses (a run of
spaces and the word behind it).  A forward Viterbi pass gives the best score
up to every place of a chunk; a backward A-star search over the lattice takes
these as its exact heuristic, so its first N complete paths are the N best.
At most N - 1 chunks can deviate from the best path in any of the N best: those
whose gap to their own second-best segmentation is smallest.  Only they
enter the search; the Viterbi pass runs for all chunks of a batch at once in numpy
and is remembered per task (bounded).

Encoding: spaces become U+2581, one is put in front; characters without a
piece become their UTF-8 bytes' pieces at a score below all others; a U+2581
in the text itself is written in bytes, so decoding always gives the text back.

Cases: null and empty texts have no pieces and decode to the empty text;
equal scores: the longer last piece first, as far as the sums of the scores are equal; very long
words and runs of one character go through a scalar pass of the same recurrence, in which
a place is left behind N times at most; repeated rows and null
ids are handled row by row; empty tables give empty results; all other
columns pass.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .keys import added
from .memory import lean
from .wordhash import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
SPACE = "▁"
LITERAL = ""                # the chunk that stands for a U+2581 of the text
SHORT = 40                  # longer chunks go through the scalar pass
REMEMBERED = 150_000        # chunks, in each task
BLOCK = 4096                # chunks in one vectorised pass
MAX_TEXT = 1 << 20          # bytes of text handled at once
FALLBACK = -1

@dataclass
class Vocabulary:
    """Pieces and scores; ships to the tasks (bounded by the vocabulary)."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    table: list[bytes]      # what each id decodes to
    longest: int = field(init=False)
    fallback: float = field(init=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.pieces), default=1)
        self.fallback = min((s for _, s in self.pieces.values()), default=0.0) - 10.0

    @classmethod
    def load(cls, model: str = MODEL) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces, byte_ids, table = {}, [0] * 256, []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(p[3:5], 16)] = i
                table.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                table.append(b"")
            else:
                pieces[p] = (i, sp.get_score(i))
                table.append(p.replace(SPACE, " ").encode())
        return cls(pieces, byte_ids, table)

    @cached_property
    def chunks(self) -> re.Pattern:
        """Splits where no piece crosses."""
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces):
            return re.compile(r".+", re.S)
        alone = "" if any("\n" in p for p in self.pieces) else "\n"
        return re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + (f"|{alone}" if alone else ""))

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids side by side, and where those of each begin."""
        start = np.concatenate([[0], np.cumsum([len(x) for x in self.table])]).astype(np.int64)
        return np.frombuffer(b"".join(self.table), dtype=np.uint8), start

    @cached_property
    def without_piece(self) -> np.ndarray:
        """By code point: whether the character has no piece of its own."""
        out = np.ones(0x110000, dtype=bool)
        out[[ord(p) for p in self.pieces if len(p) == 1]] = False
        return out

    @cached_property
    def first_states(self) -> np.ndarray:
        """The trie's state after a first letter, by the letter's number (0: no piece begins so)."""
        _, width, keys, states, _, _ = self.trie
        out = np.zeros(width, dtype=np.int64)
        top = keys < width
        out[keys[top]] = states[top]
        return out

    @cached_property
    def trie(self) -> tuple:
        """(character number by code point, sorted transition keys, their states, id and score by state)."""
        letters = sorted({c for p in self.pieces for c in p})
        number = np.zeros(0x110000, dtype=np.int64)
        for i, c in enumerate(letters, 1):
            number[ord(c)] = i
        step: dict[tuple[int, int], int] = {}
        ids, scores = [FALLBACK], [0.0]
        for p, (i, s) in self.pieces.items():
            at = 0
            for c in p:
                key = (at, int(number[ord(c)]))
                if key not in step:
                    step[key] = len(ids)
                    ids.append(FALLBACK)
                    scores.append(0.0)
                at = step[key]
            ids[at], scores[at] = i, s
        width = len(letters) + 1
        keys = np.array([a * width + c for a, c in step], dtype=np.int64)
        order = np.argsort(keys)
        return (number, width, np.append(keys[order], np.iinfo(np.int64).max),
                np.append(np.array(list(step.values()), dtype=np.int64)[order], 0),
                np.array(ids), np.array(scores))

    def edges(self, chunk: str) -> Iterator[tuple[int, int, tuple[int, ...], float]]:
        """(start, end, ids, score) of the lattice of a chunk."""
        get = self.pieces.get
        for a in range(len(chunk)):
            if chunk[a] not in self.pieces:
                yield a, a + 1, tuple(self.byte_ids[b] for b in chunk[a].encode()), self.fallback
            for b in range(a + 1, min(len(chunk), a + self.longest) + 1):
                hit = get(chunk[a:b])
                if hit is not None:
                    yield a, b, (hit[0],), hit[1]

    def __getstate__(self) -> tuple:
        return self.pieces, self.byte_ids, self.table

    def __setstate__(self, state: tuple) -> None:
        self.pieces, self.byte_ids, self.table = state
        self.__post_init__()


def a_star(vocabulary: Vocabulary, chunks: list[str], n: int) -> list[tuple[float, list[tuple[int, ...]]]]:
    """The n best segmentations of some chunks laid end to end: (score, ids of each chunk), best first.

    Forward Viterbi scores of the places are exact heuristics for what is
    still to come on the way back, so paths are completed in order of score.
    """
    into: list[list[tuple[int, tuple[int, ...], float]]] = [[]]
    part = [0]
    for k, chunk in enumerate(chunks):
        base = len(into) - 1
        into += [[] for _ in chunk]
        part += [k] * len(chunk)
        for a, b, ids, score in vocabulary.edges(chunk):
            into[base + b].append((base + a, ids, score))
    ahead = [0.0] * len(into)
    for e in range(1, len(into)):
        ahead[e] = max(ahead[a] + s for a, _, s in into[e])
    last, out, order = len(into) - 1, [], 0
    met = [0] * len(into)
    heap = [(-ahead[last], 0, last, 0.0, None)]
    while heap and len(out) < n:
        cost, _, at, behind, path = heapq.heappop(heap)
        if met[at] == n and at:                             # n better ways back to the end are known from here
            continue
        met[at] += 1
        if at == 0:
            own: list[list[int]] = [[] for _ in chunks]
            while path is not None:
                k, ids, path = path
                own[k] += ids
            out.append((-cost, [tuple(x) for x in own]))
            continue
        for a, ids, s in reversed(into[at]):                # of equal paths the last one pushed is followed first
            order -= 1
            heapq.heappush(heap, (-(ahead[a] + s + behind), order, a, s + behind, (part[at], ids, path)))
    return out


class Encoder:
    """Encodes texts; remembers the best path and the gap to the second best of chunks."""

    def __init__(self, vocabulary: Vocabulary, n: int = N_BEST) -> None:
        self.v, self.n = vocabulary, n
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}                             # chunk: its place in the arrays; goes with the task
        self.ids = np.zeros(0, dtype=np.int32)                      # the best paths laid end to end
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score, self.gap = np.zeros(0), np.zeros(0)

    def _scalar(self, chunk: str) -> tuple[np.ndarray, float, float]:
        if chunk == LITERAL:
            return np.array([self.v.byte_ids[b] for b in SPACE.encode()], dtype=np.int32), self.v.fallback, np.inf
        paths = a_star(self.v, [chunk], 2)
        return (np.array(paths[0][1][0], dtype=np.int32), paths[0][0],
                paths[0][0] - paths[1][0] if len(paths) > 1 else np.inf)

    def learn(self, chunks: set[str]) -> None:
        """Best path and gap of chunks not yet known."""
        if len(self.known) > REMEMBERED:
            self._forget()
        new = sorted(chunks - self.known.keys(), key=len)
        if not new:
            return
        size = np.fromiter(map(len, new), np.int64, len(new))
        letters = np.frombuffer("".join(new).encode("utf-32-le", "surrogatepass"), np.uint32)
        strange = np.bincount(np.repeat(np.arange(len(new)), size), self.v.without_piece[letters], len(new)) > 0
        apart = strange | (size > SHORT) | (size == 0)
        single = [self._scalar(new[i]) for i in np.flatnonzero(apart)]
        short = [new[i] for i in np.flatnonzero(~apart)]
        parts = [(np.concatenate([x for x, _, _ in single]), np.array([len(x) for x, _, _ in single]),
                  np.array([x for _, x, _ in single]), np.array([x for _, _, x in single]))] if single else []
        parts += [self._block(short[i:i + BLOCK]) for i in range(0, len(short), BLOCK)]
        names = [new[i] for i in np.flatnonzero(apart)] + short
        self.known.update(zip(names, range(len(self.known), len(self.known) + len(names))))
        ids, size, score, gap = (np.concatenate(x) for x in zip(*parts))
        self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])
        self.first = np.cumsum(self.size) - self.size
        self.score, self.gap = np.concatenate([self.score, score]), np.concatenate([self.gap, gap])

    def _block(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Viterbi over many chunks at once: lanes are chunks by length, steps are places and piece lengths.
        Every letter is a piece.  Returns the best paths laid end to end, their sizes, scores and gaps."""
        number, width, keys, states, ids, scores = self.v.trie
        size = np.array([len(c) for c in chunks])
        n, most = len(chunks), int(size.max())
        code = np.zeros((n, most), dtype=np.int64)
        code[np.arange(most) < size[:, None]] = number[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        code = np.ascontiguousarray(code.T)
        best = np.full((most + 1, n), -np.inf)
        best[0] = 0
        back, back_id = np.zeros((most + 1, n), np.int32), np.zeros((most + 1, n), np.int32)
        seen = []
        for a in range(most):
            lane = np.arange(np.searchsorted(size, a, side="right"), n)
            state = self.v.first_states[code[a, lane[0]:]]
            for b in range(a + 1, min(most, a + self.v.longest) + 1):
                if b > a + 1:
                    want = code[b - 1][lane]                        # 0, behind a chunk's end, is no letter
                    want += state * width
                    at = np.searchsorted(keys, want)
                    ok = np.flatnonzero(keys[at] == want)
                    if not len(ok):
                        break
                    lane, state = lane[ok], states[at[ok]]
                piece = ids[state]
                hit = np.flatnonzero(piece != FALLBACK)
                if not len(hit):
                    continue
                x = lane[hit]
                value = best[a][x] + scores[state[hit]]
                seen.append((x, a, b, value))
                better = np.flatnonzero(value > best[b][x])
                y = x[better]
                best[b][y], back[b][y], back_id[b][y] = value[better], a, piece[hit[better]]
        place = size.copy()
        lanes = np.arange(n)
        passed = np.zeros((most + 1, n), dtype=bool)
        path = []
        while (place > 0).any():
            live = place > 0
            passed[place[live], lanes[live]] = True
            path.append(np.where(live, back_id[place, lanes], FALLBACK))
            place = np.where(live, back[place, lanes], 0)
        gap = np.full(n, np.inf)
        for x, a, b, value in seen:                                 # x has each lane once
            other = np.flatnonzero(passed[b][x] & (back[b][x] != a))
            y = x[other]
            gap[y] = np.minimum(gap[y], best[b][y] - value[other])
        grid = np.array(path[::-1], dtype=np.int32).T               # padding first, then the path
        on = grid != FALLBACK
        return grid[on], on.sum(axis=1), best[size, lanes], gap

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        find = self.v.chunks.findall
        if SPACE not in text:
            return find(SPACE + text.replace(" ", SPACE))
        out: list[str] = []
        for k, part in enumerate((" " + text).split(SPACE)):
            out += [LITERAL] * (k > 0) + find(part.replace(" ", SPACE))
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, float, list[tuple[float, list]]]]:
        """(ids, score, alternatives) of each text.

        Alternatives, best first: (score, edits); an edit (first token,
        tokens replaced, ids instead) applies to the best path.
        """
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        count = list(map(len, split))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, sum(count))
        size, score, gap = self.size[at], self.score[at], self.gap[at]
        end = np.cumsum(size)
        ids = self.ids[np.arange(end[-1] if len(end) else 0) + np.repeat(self.first[at] - end + size, size)]
        token = np.concatenate([[0], end])                          # where each chunk's tokens begin
        done = 0
        for chunks, k in zip(split, count):
            here = slice(done, done + k)
            total = float(score[here].sum())
            yield (ids[token[done]:token[done + k]], total,
                   self._alternatives(chunks, token[done:done + k] - token[done], at[here], score[here], gap[here], total))
            done += k

    def _alternatives(self, chunks, first, at, scores, gaps, score: float) -> list[tuple[float, list]]:
        if self.n < 2 or not chunks:
            return []
        if len(gaps) >= self.n:
            limit = np.partition(gaps, self.n - 2)[self.n - 2]
            near = np.flatnonzero(gaps <= limit)
            near = near[np.argsort(gaps[near], kind="stable")][:self.n - 1]
        else:
            near = np.arange(len(gaps))
        near = np.sort(near[np.isfinite(gaps[near])]).tolist()
        if not near:
            return []
        base = [tuple(self.ids[self.first[k]:self.first[k] + self.size[k]].tolist()) for k in at[near]]
        fixed = score - float(scores[near].sum())
        out = []
        for s, own in a_star(self.v, [chunks[i] for i in near], self.n):
            edits = [(int(first[i]), len(b), list(o)) for i, b, o in zip(near, base, own) if o != b]
            out.append((fixed + s, edits))
        # the best path is among the n found; with ties it may not come first
        plain = next((k for k, (_, e) in enumerate(out) if not e), len(out) - 1)
        return out[:plain] + out[plain + 1:]


def decode_all(vocabulary: Vocabulary, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The texts of sequences of ids laid end to end (``sizes``: where each begins), like ``decode``."""
    flat, start = vocabulary.flat
    first, count = start[ids], (start[1:] - start[:-1])[ids]
    ends = np.concatenate([[0], np.cumsum(count)])
    data = flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], count)]
    offsets = ends[sizes]
    size = np.diff(offsets)
    data = np.delete(data, offsets[:-1][size > 0])          # the space in front
    offsets = np.concatenate([[0], np.cumsum(size - (size > 0))]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(size), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.large_string()).cast(pa.string())


def decode(table: list[bytes], ids) -> str:
    """The text of a sequence of ids; the space in front goes."""
    return b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")[1:]


PATHS = T.ArrayType(T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("edits", T.ArrayType(T.StructType([
        T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()),
        T.StructField("ids", T.ArrayType(T.IntegerType()))])))]))
_PATHS = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct([
    ("at", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))


def encoded(docs: DataFrame, vocabulary: Vocabulary, n: int = N_BEST, text_col: str = "text",
            names: tuple[str, str, str, str] = ("__ids", "__piece_score", "__paths", "__decoded")) -> DataFrame:
    """``docs`` with the best path's ids and score, the next n - 1 paths as edits, and the text decoded from the ids."""
    kinds = (T.ArrayType(T.IntegerType()), T.DoubleType(), PATHS, T.StringType())
    added(docs, *names)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(x, k) for x, k in zip(names, kinds)]])
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, n)
        for batch in batches:
            full = batch.set_column(place, batch.schema.names[place], batch.column(place).fill_null(""))
            done = 0
            for part in slices(full, full.schema.names[place], MAX_TEXT):
                rows = list(encoder.encode(part.column(place).to_pylist()))
                own = batch.slice(done, part.num_rows)
                done += part.num_rows
                sizes = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])])
                flat = np.concatenate([r[0] for r in rows])
                ids = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int32()))
                paths = pa.array([[{"score": s, "edits": [{"at": a, "n": k, "ids": i} for a, k, i in e]}
                                   for s, e in r[2]] for r in rows], _PATHS)
                texts = decode_all(vocabulary, flat, sizes)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, ids, pa.array([r[1] for r in rows], pa.float64()), paths, texts],
                    names=schema.names)

    return docs.mapInArrow(lean(run), schema)


def decoded(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out: str = "__decoded") -> DataFrame:
    """``rows`` and the text of a column of ids (null: null)."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])
    place, table = rows.columns.index(ids_col), vocabulary.table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if v is None else decode(table, v) for v in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(lean(run), schema)
