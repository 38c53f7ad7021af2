"""Substring dedup by seed and extend: remove passages that occur more than once.

Seeds: of the hashes of all runs of ``SEED`` words, winnowing picks the least
of each window of ``least`` words, so equal windows pick the same seed at the
same place.  A seed's reach is the stretch of words of all windows that
picked it.  Extend: seeds are joined on their hash.  Where all occurrences of
a seed agree in both directions over the whole reach (same hash of the
reach), all its windows are repeats, and where a seed has no partner, none is.
What is left are the seeds at the edges of repeats, whose reaches differ: they
are extended window by window, by joining the hashes of the single windows.
Overlapping repeated windows merge into maximal repeats, whose words go.

No pairs are made: a seed's occurrences are counted (before the shuffle too)
and its reaches' least and greatest hash compared, so a passage shared by a third of
all rows costs one row per occurrence.  Counts are written before they are joined
back, so that both sides of a join are shuffled for it and adaptive execution
can split a hot key.  Texts travel compressed.

Cases: null and empty texts have no words; texts shorter than a window lose
nothing; a window repeated inside one text counts; rows that repeat id and
text are copies like any other; null ids are told apart by their texts; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .keys import KEY, key_columns, keyed
from .wordhash import Words, mix, slices

LEAST = 35                  # words
SEED = 8                    # words
LEVEL = 1                   # of compression
MAX_PACKED = 1 << 19        # compressed bytes handled at once
U = np.uint64


class Reaches:
    """The seeds of the texts of a batch: place of each seed, first and last window that picked it."""

    def __init__(self, words: Words, least: int) -> None:
        self.least, self.words = least, words
        self.runs = words.runs()
        room = least - min(SEED, least) + 1                 # seeds in a window
        n = len(words)
        left = words.first[1:][words.row()] - np.arange(n)  # words from here to the end of the text
        starts = np.flatnonzero(left >= least)
        size = min(SEED, least)
        last = np.minimum(np.arange(n) + size, n)
        grams = self.runs(np.arange(n), last)
        at = np.arange(n)
        done = 1
        while done < room:                                  # place of the least of the next 2, 4, 8 ... seeds, the last of equals
            step = min(done, room - done)
            other = at[np.minimum(np.arange(n) + step, n - 1)] if n else at
            at = np.where(grams[other] <= grams[at], other, at)
            done += step
        owner = at[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
        head = np.flatnonzero(new)
        self.seed = owner[head]
        self.first = starts[head]
        self.last = starts[np.append(head[1:], len(starts)) - 1] if len(head) else head
        self.hash = grams[self.seed]
        place = (self.seed - self.first).astype(U) << U(32) | (self.last - self.first).astype(U)
        self.reach = mix(self.runs(self.first, self.last + least) ^ mix(place))
        self.row = words.row()[self.first]
        self.at = self.first - words.first[self.row]        # in the text


def seeds(docs: DataFrame, least: int, id_col: str, text_col: str) -> DataFrame:
    """(a, c, __kid, at): seed, reach, document (id; hash and place share a number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                r = Reaches(Words(part.column(2)), least)
                kid, kh = part.column(0).to_numpy(), part.column(1).to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.hash.view(np.int64)), pa.array(r.reach.view(np.int64)), pa.array(kid[r.row]),
                     pa.array(kh[r.row] << 32 | r.at)], names=["a", "c", "__kid", "at"])

    return keyed(docs, id_col, text_col).mapInArrow(run, "a long, c long, __kid long, at long")


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(__kid, __kh, doc_id, z): the texts, compressed for their way through the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            for part in slices(batch, "__text"):
                z = [press(t.encode()) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3),
                                                  pa.array(z, pa.binary())], names=["__kid", "__kh", "id", "z"])

    rows = docs.select(*key_columns(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
                       F.col(id_col).cast("long").alias("id"))
    return rows.mapInArrow(run, "__kid long, __kh int, id long, z binary")


def unpacked(column: pa.Array) -> pa.Array:
    plain = zstandard.ZstdDecompressor().decompress
    return pa.array([plain(z) for z in column.to_pylist()], pa.binary()).cast(pa.string())


WINDOWS = "array<struct<a:int,h:long,s:int>>"
_WINDOWS = pa.list_(pa.struct([("a", pa.int32()), ("h", pa.int64()), ("s", pa.int32())]))


def extended(rows: DataFrame, least: int) -> DataFrame:
    """(key, cover, windows) from (key, z, live).

    ``live``: the places of a text's seeds that have partners; 2 * place + 1
    if the reaches differ.  ``cover``: starts and ends of the repeats known so
    far; ``windows``: single windows to be compared, by 31 bits of the seed
    and 64 of the window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "z", MAX_PACKED):
                r = Reaches(Words(unpacked(part.column("z"))), least)
                live, row = _flat(part.column("live"))
                k = np.searchsorted(r.first, r.words.first[row] + (live >> 1))     # the same seeds as in the first pass
                differ = live & 1 == 1
                order = np.lexsort((k, differ))
                k, differ, row = k[order], differ[order], row[order]
                full = k[~differ]
                cover = _lists(row[~differ], np.column_stack([r.at[full], r.at[full] + (r.last - r.first)[full] + least]),
                               part.num_rows)
                k, row = k[differ], row[differ]
                n = (r.last - r.first)[k] + 1
                s = np.repeat(r.first[k], n) + _counting(n)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row, n, part.num_rows).astype(np.int64))])
                entries = pa.StructArray.from_arrays(
                    [pa.array(np.repeat((r.hash[k] >> U(33)).astype(np.int32), n)),
                     pa.array(r.runs(s, s + least).view(np.int64)),
                     pa.array((s - r.words.first[np.repeat(row, n)]).astype(np.int32))],
                    fields=list(_WINDOWS.value_type))
                windows = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries)
                yield pa.RecordBatch.from_arrays([part.column("__kid"), part.column("__kh"), cover, windows],
                                                 names=["__kid", "__kh", "cover", "windows"])

    return rows.mapInArrow(run, f"__kid long, __kh int, cover array<int>, windows {WINDOWS}")


def _counting(n: np.ndarray) -> np.ndarray:
    """0 .. n[0]-1, 0 .. n[1]-1 and so on."""
    total = int(n.sum())
    return np.arange(total) - np.repeat(np.cumsum(n) - n, n)


def _lists(row: np.ndarray, pairs: np.ndarray, rows: int) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(2 * np.bincount(row, minlength=rows))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(pairs.astype(np.int32).ravel()))


def finished(rows: DataFrame, least: int) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) from (id, z, cover, starts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "z", MAX_PACKED):
                words = Words(unpacked(part.column("z")))
                change = np.zeros(len(words) + 1, np.int64)
                cover, row = _flat(part.column("cover"))
                np.add.at(change, words.first[row] + cover, np.where(np.arange(len(cover)) % 2 == 0, 1, -1))
                starts, row = _flat(part.column("starts"))
                np.add.at(change, words.first[row] + starts, 1)
                np.add.at(change, words.first[row] + starts + least, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) * (words.count > 0) \
                    if part.num_rows else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(words.count.astype(np.int64)), pa.array(removed),
                     _spans(gone, words), kept_text(words, ~gone)],
                    names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, spans array<int>, kept string")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each (null: none)."""
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return (np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.int64),
            np.repeat(np.arange(len(column)), size))


def _spans(gone: np.ndarray, words: Words) -> pa.Array:
    """Maximal repeats of each text as starts and ends in words."""
    row = words.row()
    joined = np.zeros(len(gone), dtype=bool)
    joined[1:] = (row[1:] == row[:-1])
    head = gone.copy()
    head[1:] &= ~(gone[:-1] & joined[1:])
    tail = gone.copy()
    tail[:-1] &= ~(gone[1:] & joined[1:])
    a, b = np.flatnonzero(head), np.flatnonzero(tail)
    return _lists(row[a], np.column_stack([a - words.first[row[a]], b + 1 - words.first[row[a]]]), words.rows)


def kept_text(words: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of each text, joined by one space."""
    size = len(words.data)
    edge = np.zeros(size + 1, np.int8)
    at = np.flatnonzero(keep)
    edge[words.start[at]] += 1
    edge[words.end[at]] -= 1
    held = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    row = words.row()[at]
    inner = at[:-1][row[:-1] == row[1:]] if len(at) else at     # kept words with another kept one behind
    data = words.data.copy()
    data[words.end[inner]] = 32
    held[words.end[inner]] = True
    offsets = np.concatenate([[0], np.cumsum(held)])[words.offsets]
    return pa.StringArray.from_buffers(words.rows, pa.py_buffer(offsets.astype(np.int32).tobytes()),
                                       pa.py_buffer(data[held].tobytes()))


def dedup(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): every text without its repeated passages.

    What the extension finds is written to the session's shared folder once
    (places and hashes, no texts): counting the windows and putting the texts
    together both start from there.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "substrings")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    found = seeds(docs, least, id_col, text_col)
    status = kept(found.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
                  .filter("n > 1").select("a", (F.col("low") != F.col("high")).cast("long").alias("differ")), "seeds")
    live = (found.join(status, "a")
            .select("__kid", F.shiftright("at", 32).cast("int").alias("__kh"),
                    (F.col("at").bitwiseAND((1 << 32) - 1) * 2 + F.col("differ")).alias("live"))
            .groupBy(*KEY).agg(F.collect_set("live").alias("live")))         # at most a text's seeds
    texts = packed(docs, id_col, text_col)
    rows = kept(extended(texts.drop("id").join(live, KEY), least), "extended")
    windows = rows.select(*KEY, F.inline("windows"))
    repeated = kept(windows.groupBy("a", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "windows")
    starts = (windows.join(repeated, ["a", "h"])
              .groupBy(*KEY).agg(F.collect_set("s").alias("starts")))        # at most a text's windows
    marks = rows.select(*KEY, "cover").dropDuplicates(KEY).join(starts, KEY, "left")
    return finished(texts.join(marks, KEY, "left").select("id", "z", "cover", "starts"), least)
