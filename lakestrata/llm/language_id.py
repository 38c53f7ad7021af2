"""Language identification with a byte convolutional network trained in numpy.

One-hot bytes go through filters of several widths, ReLU, max pooling over a
fixed-length window and a softmax layer.  The network is fitted on the driver
to a bounded sample of labelled texts (at most ``PER_LANGUAGE`` per language and
about ``SAMPLE_TEXTS`` in all, but at least one of each language, drawn over the
whole table by a hash of the id and text); every window of every whole text is then scored inside Arrow batches and a text's
score is the mean of its windows' probabilities, weighted by their bytes.

Cases: a null text or one without any letter is ``und`` with score 0; without
labelled texts everything is ``und``; equal scores go to the language that
sorts first; repeated rows and null ids are predicted alike, row by row; an
empty table gives an empty result; all columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import added
from .memory import lean
from .wordhash import buffers, slices

WINDOW = 256                # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16               # of each width
PER_LANGUAGE = 1000         # texts of a language in the sample
SAMPLE_TEXTS = 200_000      # in all; every language is learned
SAMPLE_CHARS = 1024         # of each sampled text, from a hashed position
EPOCHS, BATCH, RATE = 5, 64, 0.01
BLOCK = 16                  # windows scored at once
UNKNOWN = "und"
CHANCE = 1.05               # of the probability that each language has by chance
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Model:
    """``tables[j]``: what the byte at offset j adds to each filter (0 to the narrower ones)."""

    languages: tuple[str, ...]
    tables: tuple[np.ndarray, ...]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def convolved(self, windows: np.ndarray) -> np.ndarray:
        """(position, window, filter); windows: (n, WINDOW) bytes, 0 for padding."""
        n = windows.shape[1]
        at = np.zeros((n + max(WIDTHS) - 1, len(windows)), dtype=np.intp)    # position-major: contiguous sums
        at[:n] = windows.T
        conv = self.tables[0].take(at[:n], axis=0, mode="clip")
        for j, table in enumerate(self.tables[1:], 1):
            conv += table.take(at[j:j + n], axis=0, mode="clip")
        return conv

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        top = self.convolved(windows).max(axis=0)
        return softmax(np.maximum(top + self.bias, 0) @ self.weights + self.offset)


def undecided(model: Model) -> float:
    """Scores up to this one tell no language from the others: ``CHANCE`` times the mean probability (0: one language or none)."""
    return CHANCE / len(model.languages) if len(model.languages) > 1 else 0.0


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut(data: np.ndarray) -> np.ndarray:
    """The windows of one text, end to end, the last one padded with zeros."""
    n = -(-len(data) // WINDOW)
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[:len(data)] = data
    return out.reshape(n, WINDOW)


def fit(texts: list[tuple[str, str]], seed: int = 7) -> Model:
    """Train on (language, text) pairs with Adam; the pairs' order does not matter."""
    texts = sorted(texts)
    languages = tuple(sorted({lang for lang, _ in texts}))
    if not languages:
        return Model((), (), np.zeros(0), np.zeros(0), np.zeros(0))
    windows = [cut(np.frombuffer(t.encode(), dtype=np.uint8)) for _, t in texts]
    x = np.concatenate(windows)
    y = np.repeat([languages.index(lang) for lang, _ in texts], [len(w) for w in windows])
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    width = np.repeat(WIDTHS, FILTERS)
    offsets = range(max(WIDTHS))
    params = [(rng.normal(0, 0.1, (256, total)) * (width > j)).astype(np.float32) for j in offsets]
    params += [np.zeros(total, np.float32), rng.normal(0, 0.1, (total, len(languages))).astype(np.float32),
               np.zeros(len(languages), np.float32)]
    for p in params[:len(offsets)]:
        p[0] = 0                                            # padding
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step, rows = 0, np.arange(BATCH)[:, None]
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(order), BATCH):
            xb, yb = x[order[i:i + BATCH]], y[order[i:i + BATCH]]
            m = Model(languages, tuple(params[:len(offsets)]), *params[len(offsets):])
            conv = m.convolved(xb)
            at = conv.argmax(axis=0)
            top = np.take_along_axis(conv, at[None], axis=0)[0]
            hidden = np.maximum(top + m.bias, 0)
            d = softmax(hidden @ m.weights + m.offset)
            d[np.arange(len(xb)), yb] -= 1
            d /= len(xb)
            back = (d @ m.weights.T) * (hidden > 0)
            grads = []
            padded = np.pad(xb, ((0, 0), (0, max(WIDTHS) - 1)))
            for j in offsets:
                g = np.zeros((256, total), np.float32)
                byte = padded[rows[:len(xb)], at + j]
                np.add.at(g, (byte, np.broadcast_to(np.arange(total), byte.shape)), back * (width > j))
                g[0] = 0
                grads.append(g)
            grads += [back.sum(axis=0), hidden.T @ d, d.sum(axis=0)]
            step += 1
            for p, g, a, b in zip(params, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return Model(languages, tuple(params[:len(offsets)]), *params[len(offsets):])


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves no remainder by 5; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                        F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    known = known.filter(F.col("text").rlike(r"\p{L}"))
    scale = 1 << 30
    mark = F.pmod(F.xxhash64("id", "text", F.lit("sample")), F.lit(scale))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(mark).alias("least")).collect()     # one row a language
    if not counts:
        return fit([])
    each = max(1, min(per_language, SAMPLE_TEXTS // len(counts)))
    #: twice as many as wanted by expected value, so that the order below meets a bounded number of rows
    below = known.sparkSession.createDataFrame(
        [(r.lang, max(int(scale * min(1.0, 2 * each / r.n)), r.least + 1)) for r in counts], "lang string, below long")
    room = F.greatest(F.char_length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    part = F.substring("text", (F.pmod(F.xxhash64("id", F.lit("place")), room) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    part = F.when(part.rlike(r"\p{L}"), part).otherwise(F.regexp_extract("text", rf"\p{{L}}(?s:.{{0,{SAMPLE_CHARS - 1}}})", 0))
    first = Window.partitionBy("lang").orderBy("mark", "id", "text")
    rows = (known.withColumn("mark", mark).join(F.broadcast(below), "lang").filter(F.col("mark") < F.col("below"))
            .select("lang", "id", part.alias("text"), "mark")
            .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= each).collect())
    return fit([(r.lang, r.text) for r in rows])


def classify(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text of a column without nulls."""
    data, offsets = buffers(column)
    n = len(column)
    sizes = np.diff(offsets)
    letter = np.zeros(256, dtype=bool)
    letter[65:91] = letter[97:123] = True
    plain = np.concatenate([[0], np.cumsum(letter[data])])
    has = plain[offsets[1:]] > plain[offsets[:-1]]
    for i in np.flatnonzero(~has & (sizes > 0)):
        has[i] = LETTER.search(data[offsets[i]:offsets[i + 1]].tobytes().decode()) is not None
    if not model.languages:                                 # nothing was learned: only the letters are known
        return [UNKNOWN] * n, np.zeros(n)
    count = np.where(has, -(-sizes // WINDOW), 0)
    first = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(n), count)
    at = offsets[text] + (np.arange(first[-1]) - first[text]) * WINDOW
    width = np.minimum(offsets[text + 1] - at, WINDOW)
    total = np.zeros((n, len(model.languages)))
    ruler = np.arange(WINDOW)
    for i in range(0, len(at), BLOCK):
        a, w = at[i:i + BLOCK], width[i:i + BLOCK]
        place = np.minimum(a[:, None] + ruler, len(data) - 1)
        p = model.probabilities(np.where(ruler < w[:, None], data[place], 0))
        np.add.at(total, text[i:i + BLOCK], p * w[:, None])
    total /= np.maximum(sizes, 1)[:, None]
    best = total.argmax(axis=1)
    return ([model.languages[b] if h else UNKNOWN for b, h in zip(best, has)],
            np.where(has, np.minimum(total[np.arange(n), best], 1.0), 0.0))


def with_language(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "__lang",
                  score_out: str = "__score") -> DataFrame:
    """``docs`` and two columns: predicted language and score; the network goes to the tasks in the closure."""
    added(docs, lang_out, score_out)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_out, T.StringType()),
                           T.StructField(score_out, T.DoubleType())])
    place = docs.columns.index(text_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            full = batch.set_column(place, batch.schema.names[place], batch.column(place).fill_null(""))
            done = 0
            for part in slices(full, full.schema.names[place]):
                langs, scores = classify(part.column(place), model)
                own = batch.slice(done, part.num_rows)
                done += part.num_rows
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(langs, pa.string()), pa.array(scores)],
                                                 names=schema.names)

    return docs.mapInArrow(lean(score), schema)
