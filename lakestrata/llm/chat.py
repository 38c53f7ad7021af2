"""Chat formatting as packed prefix trees.

A conversation is the list of its turns.  Conversations that begin with the same turns share
them: sorted by their turns they stand in depth-first order of the tree of all
conversations, and a task that reads them in that order emits a turn only where it differs
from the conversation before.  Packs of bounded length hold such turns one after
another (``nodes``) with the place of each in the pack, its first position id (that of
its conversation, counted from the root) and the intervals of the pack that its
ancestors take: a token sees these intervals and its own turn up to itself.  A pack starts
with the whole path of its first conversation, so every pack can be used alone.

A turn is ``OPEN role MIDDLE text CLOSE``.  Control strings inside roles and texts get an
escape character after their first character (one more where there are some), which
reading takes away again; no control string can begin inside another.  The loss mask covers the
texts of the roles to be learned, without the marks.

Tokens are code points, or the ids that ``encode`` gives for a list of strings (a turn's
marks and its text are encoded apart, so equal turns have equal tokens).

How it runs: one shuffle gathers the turns of a conversation, one (by range of turn
hashes) sorts distinct conversations; copies are dropped before the second by each task, so a
conversation that a third of all rows repeat sends one row a task.  A first turn shared by many
is spread over the tasks that hold the turns after it.  Conversations are joined to their
digests by key from two written tables, so that adaptive execution can split a frequent key.
A conversation is held whole by a task, like a text.

Cases: null texts and roles are empty ones; turns are ordered by turn (null first), then role,
then text, repeated rows stay; rows without a conversation id are conversations of one
turn each; a conversation longer than a pack has its own; an empty table gives empty
results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

OPEN, MIDDLE, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of common chat formats, which a text must not be able to imitate.
CONTROLS = (OPEN, MIDDLE, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"
LEARNED = ("assistant",)
PACK = 1 << 17                  # tokens of a pack; a longer conversation has one of its own
SEEN = 50_000                   # keys by which a task knows copies again
TURNS = "array<struct<role:string,text:string>>"
SPAN = "struct<start:long,end:long>"
PACKED = ("pack string, text string, tokens array<int>, "
          "nodes array<struct<parent:int,start:long,end:long,position:long>>, "
          f"sees array<array<{SPAN}>>, loss array<{SPAN}>, conversations array<struct<key:binary,node:int>>")


class Template:
    """Marks and the reversible escape of control strings."""

    def __init__(self, controls: tuple[str, ...] = CONTROLS, escape: str = ESCAPE) -> None:
        for a in controls:
            for b in controls:
                if a != b and b in a or any(b.startswith(a[k:]) or a[k:].startswith(b) for k in range(1, len(a))):
                    raise ValueError(f"{b!r} can begin inside {a!r}")
            if len(a) < 2 or escape in a:
                raise ValueError(f"{a!r} is too short or holds the escape character")
        tails: dict[str, list[str]] = {}
        for c in controls:
            tails.setdefault(c[0], []).append(re.escape(c[1:]))
        form = "|".join(f"{re.escape(head)}{{}}(?={'|'.join(rest)})" for head, rest in tails.items())
        e = re.escape(escape)
        self._inside = re.compile(form.replace("{}", f"{e}*"))
        self._escaped = re.compile(form.replace("{}", f"{e}+"))
        self.escape_char = escape

    def escape(self, text: str) -> str:
        return self._inside.sub(lambda m: m[0] + self.escape_char, text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][:-1], text)

    def turn(self, role: str, text: str) -> tuple[str, str, str]:
        """(before, text, after)."""
        return OPEN + self.escape(role) + MIDDLE, self.escape(text), CLOSE

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """The turns of a formatted conversation."""
        out = []
        for part in formatted.split(OPEN)[1:]:
            role, _, rest = part.partition(MIDDLE)
            if not rest.endswith(CLOSE):
                raise ValueError("a turn has no end")
            out.append((self.unescape(role), self.unescape(rest[:-len(CLOSE)])))
        return out


class Pack:
    """A part of the tree, depth first."""

    def __init__(self, template: Template, learned: tuple[str, ...], encode: Callable | None) -> None:
        self.template, self.learned, self.encode = template, learned, encode
        self.pieces: list[str] = []
        self.tokens: list[int] = []
        self.size = 0
        self.nodes: list[tuple[int, int, int, int]] = []
        self.sees: list[list[tuple[int, int]]] = []
        self.loss: list[tuple[int, int]] = []
        self.conversations: list[tuple[bytes, int]] = []

    def sizes(self, pieces: list[tuple[str, str, str]]) -> list[list]:
        """Per turn, the tokens (or only their numbers) of its three pieces."""
        if self.encode is None:
            return [[len(x) for x in three] for three in pieces]
        ids = iter(self.encode([x for three in pieces for x in three]))
        return [[next(ids) for _ in three] for three in pieces]

    def add(self, role: str, pieces: tuple[str, str, str], coded: list, parent: int) -> int:
        before, text, after = (c if self.encode is None else len(c) for c in coded)
        start, end = self.size, self.size + before + text + after
        if parent < 0:
            position, sees = 0, []
        else:
            _, a, b, position = self.nodes[parent]
            position, sees = position + b - a, list(self.sees[parent])
            if sees and sees[-1][1] == a:                   # ancestors side by side are one interval
                sees[-1] = (sees[-1][0], b)
            else:
                sees.append((a, b))
        self.nodes.append((parent, start, end, position))
        self.sees.append(sees)
        if role in self.learned:
            self.loss.append((start + before, start + before + text))
        self.pieces += pieces
        if self.encode is not None:
            for c in coded:
                self.tokens += c
        self.size = end
        return len(self.nodes) - 1

    def row(self, name: str) -> dict:
        spans = [{"start": a, "end": b} for a, b in self.loss]
        return {"pack": name, "text": "".join(self.pieces), "tokens": self.tokens if self.encode else None,
                "nodes": [dict(zip(("parent", "start", "end", "position"), n)) for n in self.nodes],
                "sees": [[{"start": a, "end": b} for a, b in s] for s in self.sees], "loss": spans,
                "conversations": [{"key": k, "node": n} for k, n in self.conversations]}


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_PACKED = pa.schema([
    ("pack", pa.string()), ("text", pa.string()), ("tokens", pa.list_(pa.int32())),
    ("nodes", pa.list_(pa.struct([("parent", pa.int32()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("position", pa.int64())]))),
    ("sees", pa.list_(pa.list_(_SPAN))), ("loss", pa.list_(_SPAN)),
    ("conversations", pa.list_(pa.struct([("key", pa.binary()), ("node", pa.int32())])))])


def gathered(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv_id, key, path, turns): one row a conversation; equal conversations have equal keys."""
    def text(c: str):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))

    one = rows.select(F.col(f"`{id_col}`").alias("conv_id"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")).alias("t"))
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    whole = one.groupBy("conv_id", alone.alias("alone")).agg(turns.alias("turns"))
    return whole.select("conv_id", F.unhex(F.sha2(F.to_json("turns"), 256)).alias("key"),
                        F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])).alias("path"), "turns")


def distinct_in_task(conversations: DataFrame) -> DataFrame:
    """Without the copies that a task meets again: what is left of a frequent conversation is a row a task."""
    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: OrderedDict[bytes, None] = OrderedDict()
        for batch in batches:
            keep = []
            for key in batch.column(0).to_pylist():
                keep.append(key not in seen)
                seen[key] = None
                seen.move_to_end(key)
                if len(seen) > SEEN:
                    seen.popitem(last=False)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return conversations.select("key", "path", "turns").mapInArrow(thin, f"key binary, path array<long>, turns {TURNS}")


def packs(conversations: DataFrame, template: Template | None = None, learned: tuple[str, ...] = LEARNED,
          encode: Callable[[list[str]], list[list[int]]] | None = None, most: int = PACK) -> DataFrame:
    """The packed trees of ``gathered`` conversations, each distinct one in exactly one pack."""
    template = template or Template()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        current, path, previous = Pack(template, learned, encode), [], None
        for batch in batches:
            for key, turns in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if key == previous:                         # a copy from another task
                    continue
                previous = key
                turns = [(t["role"], t["text"]) for t in turns]
                shared = 0
                while shared < min(len(turns), len(path)) and path[shared][0] == turns[shared]:
                    shared += 1
                pieces = [template.turn(*t) for t in turns[shared:]]
                coded = current.sizes(pieces)
                size = sum(c if encode is None else len(c) for three in coded for c in three)
                if current.nodes and current.size + size > most:
                    yield pa.RecordBatch.from_pylist([current.row(f"{part}-{number}")], schema=_PACKED)
                    current, number = Pack(template, learned, encode), number + 1
                    if shared:                              # a pack holds whole paths
                        first = [template.turn(*t) for t in turns[:shared]]
                        pieces, coded, shared = first + pieces, current.sizes(first) + coded, 0
                path = path[:shared]
                for turn, three, c in zip(turns[shared:], pieces, coded):
                    path.append((turn, current.add(turn[0], three, c, path[-1][1] if path else -1)))
                current.conversations.append((key, path[-1][1]))
        if current.nodes:
            yield pa.RecordBatch.from_pylist([current.row(f"{part}-{number}")], schema=_PACKED)

    ordered = distinct_in_task(conversations).repartitionByRange("path", "key").sortWithinPartitions("path", "key")
    return ordered.mapInArrow(pack, PACKED)


def visible(nodes: list[dict], sees: list[list[dict]], node: int) -> list[tuple[int, int]]:
    """The intervals of a pack that the last token of a node sees, its own turn included."""
    return [(s["start"], s["end"]) for s in sees[node]] + [(nodes[node]["start"], nodes[node]["end"])]


def digests(packed: DataFrame, template: Template | None = None) -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from packs of code points."""
    template = template or Template()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text, loss = row["text"], [(s["start"], s["end"]) for s in row["loss"]]
                out = []
                for leaf in row["conversations"]:
                    spans = visible(row["nodes"], row["sees"], leaf["node"])
                    formatted = "".join(text[a:b] for a, b in spans)
                    turns = hashlib.sha256()
                    found = template.read(formatted)
                    for role, own in found:
                        turns.update(f"{role}\n{own}\n".encode())
                    learned, chars = hashlib.sha256(), 0
                    for a, b in spans:
                        for k in range(bisect_left(loss, (a, a)), len(loss)):
                            if loss[k][0] >= b:
                                break
                            own = template.unescape(text[loss[k][0]:loss[k][1]])
                            learned.update(own.encode())
                            chars += len(own)
                    out.append((leaf["key"], len(found), turns.hexdigest(), chars, learned.hexdigest(), len(formatted)))
                kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[c] for o in out], kind) for c, kind in enumerate(kinds)],
                    names=["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return packed.select("text", "nodes", "sees", "loss", "conversations").mapInArrow(
        read, "key binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted(rows: DataFrame, template: Template | None = None, learned: tuple[str, ...] = LEARNED,
              most: int = PACK) -> tuple[DataFrame, DataFrame]:
    """(packs, members): the packed trees and (conv_id, key) of every conversation, both written tables."""
    spark = rows.sparkSession
    folder = scratch_path(spark, "chat")
    whole = gathered(rows)
    whole.write.parquet(f"{folder}/conversations")
    stored = spark.read.schema(whole.schema).parquet(f"{folder}/conversations")
    made = packs(stored, template, learned, None, most)
    made.write.parquet(f"{folder}/packs")
    return spark.read.schema(made.schema).parquet(f"{folder}/packs"), stored.select("conv_id", "key")


def read_back(packed: DataFrame, members: DataFrame, template: Template | None = None) -> DataFrame:
    """One row a conversation: what its pack gives back."""
    spark = packed.sparkSession
    folder = scratch_path(spark, "chat-digests")
    made = digests(packed, template)
    made.write.parquet(folder)
    return members.join(spark.read.schema(made.schema).parquet(folder), "key").drop("key")
