"""Vectorised word spans and span hashes over Arrow string columns (numpy).

One pass of prefix sums over the bytes of a batch gives the hash of any byte
span, and one over its words the hash of any run of words, both in O(1).
Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``; UTF-8 continuation
bytes never fall into that class, so bytes may be used for characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
MAX_BYTES = 1 << 19         # text handled at once by a task (one longer text: itself)

_U = np.uint64
_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xC2B2AE3D27D4EB4F | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.zeros(0, dtype=_U)

    def forget(self) -> None:
        self.up = self.down = np.zeros(0, dtype=_U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BASE), _Powers(_WORD_BASE)


def forget() -> None:
    """Drop the powers kept for the next batch."""
    _BYTE_POWERS.forget()
    _WORD_POWERS.forget()


_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


class RunHash:
    """Hashes of runs ``[start, end)`` of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, powers: _Powers, salt: int = 0) -> None:
        up, self.down = powers.get(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=_U)
        np.cumsum(values * up[:-1], out=self.sums[1:])
        self.salt = _U(salt & _M64)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(h ^ (np.asarray(end - start).astype(_U) * _U(0xA0761D6478BD642F)) ^ self.salt)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without nulls; offsets start at 0."""
    n = len(column)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    if n == 0 or bufs[1] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    offsets = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, most: int = MAX_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch with about ``most`` bytes of text each, so memory stays bounded."""
    _, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = j


class Words:
    """Words of a string column: byte spans, the row each starts in, and hashes."""

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        self.data, self.offsets = buffers(column)
        self.rows, size = len(column), len(self.data)
        solid = ~_IS_SPACE[self.data]
        cut = np.zeros(size + 1, dtype=bool)        # a text starts or ends here
        cut[self.offsets] = True
        before = np.zeros(size, dtype=bool)
        after = np.zeros(size, dtype=bool)
        before[1:], after[:-1] = solid[:-1], solid[1:]
        self.start = np.flatnonzero(solid & (~before | cut[:-1]))
        self.end = np.flatnonzero(solid & (~after | cut[1:])) + 1
        #: words of row r: first[r] to first[r + 1]
        self.first = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.first)
        values = _BYTE_VALUE[_LOWER] if lower else _BYTE_VALUE
        self.hash = RunHash(values[self.data], _BYTE_POWERS)(self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(self.rows), self.count)

    def runs(self, salt: int = 0) -> RunHash:
        """Hashes of runs of words."""
        return RunHash(self.hash, _WORD_POWERS, salt)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()
