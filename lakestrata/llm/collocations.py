"""Phrase collocations over a prefix-free parse of the corpus.

Texts are words in pieces (cut at punctuation and line ends).  A place where the hash
of ``most - 1`` words meets a condition is a trigger: a chunk goes from one trigger to
the next and holds both, so chunks overlap by ``most - 1`` words and equal passages give
equal chunks wherever they stand.  The distinct chunks are the dictionary, their
numbers the parse frequencies.  Phrases are counted inside each distinct chunk once,
weighted by its frequency; a phrase that begins in the overlap at a chunk's end belongs
to the next chunk, so every occurrence counts once.

Words and pairs are counted in one pass.  A longer phrase can only be frequent if both its
parts without the last and without the first word are, so it is counted where a bitmap of
the frequent shorter ones (by hash; fixed size) has both.  The bitmap only saves work: rare
phrases that pass it are counted exactly and dropped.  Inside a task phrases are
added up by 64-bit hashes in numpy; what has the hash but not the words of the group's first
phrase is handed on by itself, and Spark adds up by the phrases.

Counts, not texts, are joined to phrases; the tables they are joined with are written to the
session's shared folder first, so that adaptive execution can split a frequent part's rows.

Cases: null and empty texts have no phrase; a null language is ``und``, like that
label; rows are counted one by one, repeated rows as often as they come (ids play no part);
an empty table gives an empty result; ties go to the phrase that comes first by its UTF-8
bytes; other columns are ignored.  Scores are whole numbers from exact 38-digit decimals:
counts may go up to 10**15.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .wordhash import Words, buffers, mix, slices

MOST = 3                        # words of the longest phrases
LEAST_COUNT = 10
TOP = 2000
SCALE = 1_000_000
COVERED = 50                    # per cent of a phrase's occurrences that lie in one longer candidate
TRIGGER = 20                    # every TRIGGERth place begins a chunk, on average
SLOT_BITS = 26                  # bitmap of frequent phrases: 2**26 bits, 8 MB
COUNTED = 4 << 20               # bytes of chunks that a task counts at once
UNKNOWN = "und"

_U = np.uint64
_SPACE, _BREAK = 32, 10
#: bytes as chunks hold them: A-Z in lower case, a line end for each byte that ends a piece
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_PLAIN[9] = _SPACE


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] numbers), start[1], ..."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


def strings(data: np.ndarray, count: np.ndarray) -> pa.Array:
    """Strings of ``count`` bytes each, side by side in ``data``."""
    offsets = np.concatenate([[0], np.cumsum(count)])
    kind = pa.large_string() if offsets[-1] >= 1 << 31 else pa.string()
    return pa.Array.from_buffers(kind, len(count), [
        None, pa.py_buffer(offsets.astype(np.int64 if kind == pa.large_string() else np.int32).tobytes()),
        pa.py_buffer(data.tobytes())])


def plain(texts: pa.Array) -> pa.Array:
    data, offsets = buffers(texts)
    return strings(_PLAIN[data], np.diff(offsets))


def chunks(texts: pa.Array, width: int, trigger: int = TRIGGER) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, chunk, whether it ends its text): words are joined by one space, or by a line end where a piece ends."""
    w = Words(plain(texts))
    n = len(w)
    row = w.row()
    left = w.first[row + 1] - np.arange(n)                  # words up to the text's end
    begins = np.zeros(n, dtype=bool)
    inner = np.flatnonzero(left > width)                    # more than the overlap must be left
    begins[inner] = w.runs()(inner, inner + width) % _U(trigger) == 0
    begins[w.first[:-1][w.count > 0]] = True
    at = np.flatnonzero(begins)
    after = np.append(at[1:], n)
    last = after == w.first[row[at] + 1]
    count = np.where(last, after, after + width) - at       # words
    lines = np.concatenate([[0], np.cumsum(w.data == _BREAK)])
    joint = np.full(n, _SPACE, dtype=np.uint8)
    joint[:-1][lines[w.start[1:]] > lines[w.end[:-1]]] = _BREAK
    word = ragged(at, count)
    size = (w.end - w.start)[word]
    final = np.cumsum(count) - 1                            # the last word of each chunk has no joint
    long = size + 1
    long[final] -= 1
    data = np.append(w.data, np.uint8(0))[ragged(w.start[word], long)]
    ends = np.cumsum(long)
    inside = np.ones(len(word), dtype=bool)
    inside[final] = False
    data[ends[inside] - 1] = joint[word[inside]]
    bytes_of = np.add.reduceat(long, final + 1 - count) if len(at) else np.zeros(0, np.int64)
    return row[at], strings(data, bytes_of), last


def dictionary(docs: DataFrame, most: int = MOST, text_col: str = "text", lang_col: str = "lang",
               trigger: int = TRIGGER) -> DataFrame:
    """(lang, chunk, last, n): the distinct chunks of each language and their parse frequencies."""
    width = max(1, most - 1)
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit(UNKNOWN)).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                row, chunk, last = chunks(part.column(1), width, trigger)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), chunk.cast(pa.string()), pa.array(last)],
                                                 names=["lang", "chunk", "last"])

    counted = rows.mapInArrow(parse, "lang string, chunk string, last boolean")
    return counted.groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("n"))


def lang_keys(langs: pa.Array) -> np.ndarray:
    """A 64-bit key of each row's language."""
    coded = langs.dictionary_encode()
    keys = mix(np.array([crc32(x.encode()) for x in coded.dictionary.to_pylist()], dtype=_U))
    return keys[coded.indices.to_numpy()] if len(langs) else keys


def counted(langs: pa.Array, chunk: pa.Array, last: np.ndarray, n: np.ndarray, sizes: tuple[int, ...], most: int,
            frequent: bytes | None, bits: int) -> Iterator[pa.RecordBatch]:
    """(phrase, n) of the phrases of some chunks, added up by their hashes; a tab and the language follow the phrase."""
    width = max(1, most - 1)
    w = Words(chunk)
    row = w.row()
    left = w.first[row + 1] - np.arange(len(w))
    own = last[row] | (left > width)                        # others begin in the next chunk
    runs, key = w.runs(), lang_keys(langs)[row]
    bitmap = None if frequent is None else np.frombuffer(frequent, dtype=np.uint8)
    joined = np.zeros(len(w), dtype=bool)                   # with the next word, in one piece
    joined[:-1] = w.data[w.end[:-1]] == _SPACE
    for size in sizes:
        valid = own & (left >= size)
        for k in range(size - 1):
            valid[:len(w) - k] &= joined[k:]
        at = np.flatnonzero(valid)
        if bitmap is not None:
            for k in (0, 1):
                slot = (mix(runs(at + k, at + k + size - 1) ^ key[at]) >> _U(64 - bits)).astype(np.int64)
                at = at[bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1]
        if not len(at):
            continue
        hashes = runs(at, at + size) ^ key[at]
        order = np.argsort(hashes, kind="stable")
        at, hashes = at[order], hashes[order]
        new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        first = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        other = (w.end[at + size - 1] - w.start[at]) != (w.end[first + size - 1] - w.start[first])
        for k in range(size):                               # same hash, other words: by themselves
            other |= w.hash[at + k] != w.hash[first + k]
        new |= other
        new[1:] |= other[:-1]
        lead = np.flatnonzero(new)
        total = np.add.reduceat(n[row[at]], lead)
        at = at[lead]
        long = w.end[at + size - 1] - w.start[at]
        phrase = strings(w.data[ragged(w.start[at], long)], long)
        named = pc.binary_join_element_wise(phrase, langs.take(pa.array(row[at])).cast(phrase.type), pa.scalar("\t", phrase.type))
        yield pa.RecordBatch.from_arrays([named.cast(pa.string()), pa.array(total)], names=["phrase", "n"])


def counts(chunk_table: DataFrame, sizes: tuple[int, ...], most: int, frequent: bytes | None = None,
           bits: int = SLOT_BITS) -> DataFrame:
    """(phrase, n): occurrences of the phrases of some sizes, partly counted; with a bitmap, of those only whose
    parts without the last and without the first word it holds.  One string holds phrase, tab (which no phrase
    holds) and language: rows to be shuffled are smaller so."""
    shared = chunk_table.sparkSession.sparkContext.broadcast(frequent)      # 2**bits bits at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            langs, chunk, last, n = (table.column(c).chunk(0) for c in range(4))
            yield from counted(langs, chunk, last.to_numpy(zero_copy_only=False), n.to_numpy(), sizes, most,
                               shared.value, bits)

        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "chunk", COUNTED):
                if part.num_rows:
                    held.append(part)
                    size += len(buffers(part.column(1))[0])
                    if size >= COUNTED:
                        yield from out(held)
                        held, size = [], 0
        if held:
            yield from out(held)

    return chunk_table.select("lang", "chunk", "last", "n").mapInArrow(
        count, "phrase string, n long")


def bitmap(phrases: DataFrame, bits: int = SLOT_BITS) -> bytes:
    """Bits of the slots of some phrases: 4 KB pieces made by Spark, 2**bits bits at most in all."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Words(batch.column(1))
            hashes = mix(w.runs()(w.first[:-1], w.first[1:]) ^ lang_keys(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array((hashes >> _U(64 - bits)).astype(np.int64) + 1)], names=["slot"])

    slot = F.col("slot")                                    # Spark's bitmaps count from 1
    pieces = (phrases.select("lang", "phrase").mapInArrow(place, "slot long")
              .groupBy(F.bitmap_bucket_number(slot).alias("piece"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")))
    out = bytearray(1 << bits - 3)
    for piece, held in pieces.toLocalIterator():
        at = (piece - 1) * 4096
        out[at:at + len(held)] = held[:len(out) - at]
    return bytes(out)


def frequent_phrases(spark: SparkSession, chunk_table: DataFrame, most: int = MOST, least: int = LEAST_COUNT,
                     bits: int = SLOT_BITS) -> list[DataFrame]:
    """For each length, (lang, phrase, n) of the phrases that occur ``least`` times or more: written tables."""
    folder, out, held = scratch_path(spark, "phrases"), [], None
    for sizes in [(1, 2), *[(k,) for k in range(3, most + 1)]]:
        phrase = F.substring_index("named", "\t", 1)
        found = (counts(chunk_table, sizes, most, held, bits).groupBy(F.col("phrase").alias("named"))
                 .agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
                 .select(F.expr("substring(named, instr(named, '\t') + 1)").alias("lang"), phrase.alias("phrase"), "n",
                         F.size(F.split(phrase, " ")).alias("size")))
        path = f"{folder}/{sizes[-1]}"
        found.write.partitionBy("size").parquet(path)
        kind = T.StructType([f for f in found.schema.fields if f.name != "size"] + [T.StructField("size", T.IntegerType())])
        stored = spark.read.schema(kind).parquet(path)
        out += [stored.filter(F.col("size") == k).drop("size") for k in sizes]
        if sizes[-1] < most:
            held = bitmap(out[-1], bits)
    return out[:most]


def whole(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def collocations(docs: DataFrame, most: int = MOST, least: int = LEAST_COUNT, top: int = TOP, covered: int = COVERED,
                 text_col: str = "text", lang_col: str = "lang", trigger: int = TRIGGER) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``most`` words."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "chunks")
    made = dictionary(docs, most, text_col, lang_col, trigger)
    made.write.parquet(folder)
    chunk_table = spark.read.schema(made.schema).parquet(folder)
    tables = frequent_phrases(spark, chunk_table, most, least)
    width = max(1, most - 1)
    own = F.size(F.split("chunk", "[ \n]")) - F.when(F.col("last"), 0).otherwise(width)
    totals = chunk_table.groupBy("lang").agg(F.sum(own * F.col("n")).alias("total"))

    cuts, longer = None, None
    for size in range(2, most + 1):
        words = tables[size - 1].select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
        for k in range(1, size):
            left, right = (t.select("lang", F.col("phrase").alias(c), F.col("n").alias(c[0]))
                           for t, c in ((tables[k - 1], "left"), (tables[size - k - 1], "right")))
            cut = (words.withColumn("left", F.array_join(F.slice("w", 1, k), " "))
                   .withColumn("right", F.array_join(F.slice("w", k + 1, size - k), " "))
                   .join(left, ["lang", "left"]).join(right, ["lang", "right"])
                   .select("lang", "phrase", "a", F.lit(k).alias("k"), "l", "r"))
            cuts = cut if cuts is None else cuts.unionByName(cut)
        if size > 2:                                        # shorter candidates inside this one
            inside = words.select("lang", "a", F.explode(F.array(*[
                F.array_join(F.slice("w", i + 1, s), " ") for s in range(2, size) for i in range(size - s + 1)])).alias("phrase"))
            longer = inside if longer is None else longer.unionByName(inside)
    if cuts is None:
        raise ValueError("phrases have two words or more: most must be 2 at least")
    score = F.expr(f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(15,0)))"
                   " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r"))
    if longer is not None:
        most_inside = longer.groupBy("lang", "phrase").agg(F.max("a").alias("in_longer"))
        best = (best.join(most_inside, ["lang", "phrase"], "left")
                .filter(F.col("in_longer").isNull() | (whole(F.col("in_longer")) * 100 < whole(F.col("a")) * covered)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
