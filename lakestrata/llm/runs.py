"""Periodic runs of words, found online by dyadic square catching.

Words are appended to a stream.  For each power of two L, every completed block
of L words has a catcher: while the next words come it compares the block with the
newest L words, at distances of 2L - 1 to 4L - 2 words, so that a word is looked at by
two catchers of each level.  A square whose half is that long holds a completed
block in its first half, so one catcher meets it.  Blocks that match at one distance
side by side form a stretch; a stretch is widened word by word to both sides and is
a run once it holds a square.  A stretch that reaches the newest word stays open and
goes on with the next words.  Distances that are multiples of the period of a run that
covers them are left to that run.

Windows of L words are compared by names made from the names of their halves (64-bit
mixes); stretches are then compared word by word (by 64-bit hashes of the words), so a
chance match of names makes no run.  Only the names of the last few blocks of a
level are kept: memory grows with the words, not with the words times the levels.

Documents of a batch are one stream with a word of its own after each document,
which no run crosses.

Cases: null texts have no words and no run, like empty ones; a run needs ``exponent`` (two
or more) periods and ``least`` words; rows are treated one by one, so null and repeated ids
keep their rows; an empty table gives an empty result; extra columns pass through
(the added columns take free names, see ``with_runs``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .wordhash import mix, slices

EXPONENT = 4
LEAST = 6
BATCH_BYTES = 1 << 20           # text handled at once by a task (one longer text: itself)
COMPARED = 1 << 22              # word pairs compared at once

_U = np.uint64
_LEFT, _RIGHT = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
NONE = np.zeros(0, dtype=np.int64)
SPAN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


class Level:
    """Names of the windows of one length: those that coming blocks and windows still need."""

    def __init__(self, length: int) -> None:
        self.length, self.base, self.names = length, 0, np.zeros(0, dtype=_U)

    @property
    def end(self) -> int:
        return self.base + len(self.names)

    def extend(self, names: np.ndarray) -> None:
        self.names = np.concatenate([self.names, names])

    def at(self, start: np.ndarray) -> np.ndarray:
        return self.names[start - self.base]

    def trim(self) -> None:
        spare = len(self.names) - 6 * self.length
        if spare > 0:
            self.names, self.base = self.names[spare:].copy(), self.base + spare


class Catchers:
    """The stream of words and its runs so far."""

    def __init__(self, exponent: int = EXPONENT, least: int = LEAST, longest: int | None = None) -> None:
        """``longest``: no run can be longer (the longest document), if that is known."""
        if exponent < 2:
            raise ValueError("a run holds a square: exponent must be 2 or more")
        self.exponent, self.least, self.longest = exponent, least, longest
        self.words = np.zeros(0, dtype=_U)
        self.levels = [Level(1)]
        #: stretches that reach the newest word: start by distance, and closed ones: (start, end, distance)
        self.open: dict[int, int] = {}
        self.closed: list[np.ndarray] = []

    def append(self, words: np.ndarray) -> None:
        """Go on with any number of words (64-bit hashes)."""
        old = len(self.words)
        self.words = np.concatenate([self.words, words.astype(_U)])
        if len(self.words) == old:
            return
        self._go_on(old)
        known = self._known()
        level = 0
        while level < len(self.levels) or self._another():
            if level == len(self.levels):
                self.levels.append(Level(2 * self.levels[-1].length))
            fresh = self._name(level)
            for side in (0, 1):
                found = self._caught(level, fresh, side, known)
                if len(found):
                    known = self._known()
            level += 1
        for one in self.levels:
            one.trim()

    def _another(self) -> bool:
        """Whether a window of twice the greatest length is there, and a run could have that level's periods."""
        length = 2 * self.levels[-1].length
        return length <= len(self.words) and (
            self.longest is None or self.exponent * (2 * length - 1) <= self.longest)

    def runs(self) -> np.ndarray:
        """(start, length, period) of the maximal runs, by start, then period."""
        n = len(self.words)
        now = np.array([(s, n, p) for p, s in self.open.items()], dtype=np.int64).reshape(-1, 3)
        spans = np.concatenate([*self.closed, now]) if self.closed else now
        spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
        if len(spans):                                      # one stretch has one smallest period
            spans = spans[np.concatenate([[True], (np.diff(spans[:, :2], axis=0) != 0).any(axis=1)])]
        length = spans[:, 1] - spans[:, 0]
        spans = spans[length >= np.maximum(self.least, self.exponent * spans[:, 2])]
        out = np.column_stack([spans[:, 0], spans[:, 1] - spans[:, 0], spans[:, 2]])
        return out[np.lexsort((out[:, 2], out[:, 0]))]

    def _known(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squares so far by start: starts, the farthest end up to there and the distance that reaches it."""
        n = len(self.words)
        now = np.array([(s, n, p) for p, s in self.open.items() if n - s >= 2 * p], dtype=np.int64).reshape(-1, 3)
        spans = np.concatenate([*self.closed, now]) if self.closed else now
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        if not len(spans):
            return NONE, NONE, NONE
        far = np.maximum.accumulate(spans[:, 1])
        best = np.maximum.accumulate(np.where(spans[:, 1] == far, np.arange(len(spans)), 0))
        return spans[:, 0], far, spans[best, 2]

    def _go_on(self, old: int) -> None:
        """Open stretches go on over the new words, or close."""
        for p, s in list(self.open.items()):
            a, step, n = old, 64, len(self.words)
            while a < n:                                    # doubling steps up to the first difference
                b = min(n, a + step)
                differ = np.flatnonzero(self.words[a:b] != self.words[a - p:b - p])
                if len(differ):
                    a += int(differ[0])
                    break
                a, step = b, 2 * step
            if a < n:
                del self.open[p]
                self._close(np.array([[s, a, p]], dtype=np.int64))

    def _close(self, spans: np.ndarray) -> None:
        kept = spans[spans[:, 1] - spans[:, 0] >= self.exponent * spans[:, 2]]
        if len(kept):
            self.closed.append(kept)

    def _name(self, k: int) -> tuple[int, int]:
        """Name the windows that the new words complete; their range of starts."""
        one, n = self.levels[k], len(self.words)
        first, last = one.end, max(one.end, n - one.length + 1)
        if last > first:
            if k == 0:
                one.extend(mix(self.words[first:last]))
            else:
                half = self.levels[k - 1]
                starts = np.arange(first, last)
                one.extend(mix(half.at(starts) * _LEFT + half.at(starts + half.length) * _RIGHT))
        return first, last

    def _caught(self, k: int, fresh: tuple[int, int], side: int, known: tuple) -> np.ndarray:
        """Compare the newest windows with one of their two blocks; widen what matches."""
        one, length = self.levels[k], self.levels[k].length
        near = 2 * length - 1
        first = max(fresh[0], near + side * length)
        if first >= fresh[1]:
            return NONE
        if fresh[1] - first < 4 * length:
            starts = np.arange(first, fresh[1])
            at = ((starts - near) // length - side) * length
            hits = np.flatnonzero(one.at(starts) == one.at(at))
            start, distance = at[hits], (starts - at)[hits]
        else:
            start, distance = self._blockwise(one, first, fresh[1], near, side)
        if not len(start):
            return NONE
        start, distance = self._unknown(start, distance, length, known)
        return self._stretches(start, distance, length) if len(start) else NONE

    @staticmethod
    def _blockwise(one: Level, first: int, last: int, near: int, side: int) -> tuple[np.ndarray, np.ndarray]:
        """(block start, distance) of matches: each block stands beside a row of windows, no index arrays."""
        length = one.length
        block = (first - near) // length - side             # of the first window
        lead = first - (block * length + near + side * length)
        rows = -(-(last - first + lead) // length)
        windows = np.zeros(rows * length, dtype=_U)
        windows[lead:lead + last - first] = one.names[first - one.base:last - one.base]
        own = one.names[block * length - one.base:(block + rows - 1) * length - one.base + 1:length]
        equal = windows.reshape(rows, length) == own[:, None]
        flat = equal.reshape(-1)
        flat[:lead] = False
        flat[lead + last - first:] = False
        row, offset = np.nonzero(equal)
        return (block + row) * length, near + side * length + offset

    @staticmethod
    def _unknown(start: np.ndarray, distance: np.ndarray, length: int, known: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Without the matches inside a known square whose distance divides theirs."""
        starts, ends, periods = known
        if not len(starts):
            return start, distance
        at = np.searchsorted(starts, start, side="right") - 1
        there = np.maximum(at, 0)
        inside = (at >= 0) & (ends[there] >= start + distance + length) & (distance % periods[there] == 0)
        return start[~inside], distance[~inside]

    def _stretches(self, start: np.ndarray, distance: np.ndarray, length: int) -> np.ndarray:
        """Matching blocks side by side as stretches, widened; new runs and stretches still open."""
        order = np.lexsort((start, distance))
        start, distance = start[order], distance[order]
        if self.open:                                       # an open stretch of that distance goes on by itself
            held = np.array([self.open.get(int(p), -1) for p in distance])
            keep = (held < 0) | (start < held)
            start, distance = start[keep], distance[keep]
            if not len(start):
                return NONE
        new = np.concatenate([[True], (np.diff(distance) != 0) | (np.diff(start) != length)])
        lead = np.flatnonzero(new)
        low, p = start[lead], distance[lead]
        high = start[np.concatenate([lead[1:] - 1, [len(start) - 1]])] + length + p
        n = len(self.words)
        # at most length - 1 words to each side; what can't be long enough and doesn't reach the end goes
        long = (high - low + 2 * (length - 1) >= self.exponent * p) | (high + length > n)
        low, high, p = low[long], high[long], p[long]
        out = [NONE.reshape(0, 3)]
        begin = 0
        while begin < len(low):                             # bounded work at once
            size = np.cumsum(high[begin:] - low[begin:] + 2 * length)
            end = begin + max(1, int(np.searchsorted(size, COMPARED, side="right")))
            out.append(self._widened(low[begin:end], high[begin:end], p[begin:end], length))
            begin = end
        spans = np.concatenate(out)
        still = spans[:, 1] == n
        for s, _, q in spans[still].tolist():
            self.open[q] = min(s, self.open.get(q, s))
        self._close(spans[~still])
        return spans

    def _widened(self, low: np.ndarray, high: np.ndarray, p: np.ndarray, length: int) -> np.ndarray:
        """(start, end, distance): maximal stretches of equal words that meet the given ones."""
        n = len(self.words)
        a, b = np.maximum(low - length, 0), np.minimum(high + length, n) - p      # pairs (i, i + p), a <= i < b
        count = b - a
        ends = np.cumsum(count)
        row = np.repeat(np.arange(len(a)), count)
        i = np.arange(ends[-1]) - np.repeat(ends - count, count) + a[row]
        same = self.words[i] == self.words[i + p[row]]
        edge = np.zeros(len(i), dtype=bool)                 # a stretch starts here
        edge[ends - count] = True
        before = np.concatenate([[False], same[:-1]])
        first = np.flatnonzero(same & (edge | ~before))
        last_of_row = np.zeros(len(i), dtype=bool)
        last_of_row[ends - 1] = True
        after = np.concatenate([same[1:], [False]])
        last = np.flatnonzero(same & (last_of_row | ~after))
        r = row[first]
        out = np.column_stack([i[first], i[last] + 1 + p[r], p[r]])
        return out[(out[:, 1] > low[r]) & (out[:, 0] < high[r])]


def periodic_runs(documents: list[list[bytes]], exponent: int = EXPONENT, least: int = LEAST) -> list[np.ndarray]:
    """(start, length, period) of the runs of each document, by start, then period."""
    count = np.array([len(d) for d in documents], dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(count + 1)])
    stream = np.empty(int(offsets[-1]), dtype=_U)
    for k, words in enumerate(documents):
        stream[offsets[k]:offsets[k + 1] - 1] = np.fromiter(map(hash, words), np.int64, len(words)).view(_U)
        stream[offsets[k + 1] - 1] = mix(np.array([k], dtype=_U) ^ _LEFT)[0]
    caught = Catchers(exponent, least, int(count.max(initial=0)))
    caught.append(stream)
    runs = caught.runs()
    doc = np.searchsorted(offsets, runs[:, 0], side="right") - 1
    cut = np.searchsorted(doc, np.arange(len(documents) + 1))
    runs[:, 0] -= offsets[doc]
    return [runs[cut[k]:cut[k + 1]] for k in range(len(documents))]


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """Without the words that any run holds after its first period."""
    if not len(runs):
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def with_runs(docs: DataFrame, text_col: str = "text", exponent: int = EXPONENT, least: int = LEAST,
              runs: str = "runs", kept: str = "collapsed") -> DataFrame:
    """All columns of ``docs`` but its text, with ``runs`` (array of start, length, period, by start, then period) and
    ``kept``, the text's words without those that a run holds after its first period, joined by one space.

    One pass over the rows, without a shuffle.  The names of the two added columns must not be
    those of columns of ``docs``.
    """
    clash = {runs, kept} & {c for c in docs.columns if c != text_col}
    if clash:
        raise ValueError(f"{sorted(clash)} are columns already; name others by runs= and kept=")
    names = [c for c in docs.columns if c != text_col]
    frame = docs.select(*[F.col(f"`{c}`") for c in names],
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(kept))
    schema = T.StructType([*frame.schema.fields[:-1], T.StructField(runs, T.ArrayType(SPAN)),
                           T.StructField(kept, T.StringType())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, kept, BATCH_BYTES):
                # bytes.split() cuts at the six ASCII spaces, as the words' definition does
                documents = [t.split() for t in part.column(part.num_columns - 1).cast(pa.binary()).to_pylist()]
                found = periodic_runs(documents, exponent, least)
                texts = pa.array([b" ".join(collapsed(d, r)) for d, r in zip(documents, found)], pa.binary())
                flat = np.concatenate([NONE.reshape(0, 3), *found])
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(flat[:, c], pa.int64()) for c in range(3)],
                                                   names=SPAN.fieldNames())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), spans), texts.cast(pa.string())],
                    names=[*names, runs, kept])

    return frame.mapInArrow(find, schema)
