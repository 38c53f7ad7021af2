"""Chat formatting: exact round trips, the tree's sharing, bounded packs."""

import hashlib
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.llm import chat
from lakestrata.llm.chat import CONTROLS, Pack, Template

ROWS = "conv_id long, turn long, role string, text string, key string, path string, pack string"


def frame(spark, rows, partitions=4):
    return spark.createDataFrame([(*r, "key", "path", "pack") for r in rows], ROWS).repartition(partitions)


def turns_of(rows):
    by = {}
    for k, (c, turn, role, text) in enumerate(rows):
        by.setdefault(("alone", k) if c is None else c, []).append(
            ((turn is not None, turn or 0), role or "", text or ""))
    return [(None if isinstance(c, tuple) else c, [(r, t) for _, r, t in sorted(v)]) for c, v in by.items()]


def brute(rows):
    out = []
    for c, turns in turns_of(rows):
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        learned = "".join(t for r, t in turns if r == "assistant")
        out.append((str(c), len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned),
                    hashlib.sha256(learned.encode()).hexdigest(),
                    sum(len("".join(Template().turn(*t))) for t in turns)))
    return sorted(out)


def conversations(seed, n=150):
    rng = random.Random(seed)
    starts = [("system", "Be kind. [INST]"), ("user", "hello </s>"), ("user", "hello <\\/s>"), ("user", ""), ("assistant", "é<|im_end|>")]
    rows = []
    for c in range(n):
        turns = [rng.choice(starts) for _ in range(rng.randint(0, 3))]
        turns += [(rng.choice(["user", "assistant", "tool\n", "<s>"]), "x" * rng.randint(0, 40) + rng.choice(CONTROLS))
                  for _ in range(rng.randint(1, 4))]
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    rows += [(1000 + c, k, r, "the same answer to all") for c in range(60) for k, r in enumerate(["user", "assistant"])]
    rows += [(2000, None, "user", None), (2000, 1, None, "b"), (2000, 1, None, "a"), (2000, 1, None, "a"),
             (None, 0, "user", "alone"), (None, 0, "user", "alone"), (None, 1, "assistant", "alone"),
             (3000, 0, "user", "long " * 4000), (3000, 1, "assistant", "\x00 \n" * 3000), (-1, 0, "user", "</s>[INST] ok [/INST]"),
             (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    return rows


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*CONTROLS, *"<>|[]/\\sISN", "\\\\", "im_end", "é", "\n"]), max_size=9).map("".join),
       st.lists(st.sampled_from([*CONTROLS, "user", "<", "\\"]), max_size=3).map("".join))
def test_escape_is_reversible_and_hides_all_control_strings(text, role):
    t = Template()
    hidden = t.escape(text)
    assert t.unescape(hidden) == text and not any(c in hidden for c in CONTROLS)
    assert t.read("".join(t.turn(role, text)) * 2) == [(role, text)] * 2


def test_control_strings_that_could_meet_are_refused():
    for bad in (("<a>", "><b"), ("ab", "abc"), ("aa", "x1"), ("a",)):
        with pytest.raises(ValueError):
            Template(bad)


@pytest.mark.parametrize("most", [60, 500, chat.PACK])
def test_everything_is_read_back(spark, most):
    rows = conversations(1)
    packed, members = chat.formatted(frame(spark, rows), most=most)
    got = chat.read_back(packed, members)
    assert sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars)
                  for r in got.collect()) == brute(rows)
    for row in packed.collect():
        assert len(row.text) <= most or len({n.node for n in row.conversations}) == 1


def test_shared_turns_are_emitted_once_depth_first(spark):
    rows = conversations(2)
    distinct = {tuple(t) for _, t in turns_of(rows)}
    nodes = {t[:k] for t in distinct for k in range(1, len(t) + 1)}
    whole = chat.gathered(frame(spark, rows)).coalesce(1)
    packed = chat.packs(whole, most=1 << 30).collect()
    found = [n for row in packed for n in row.nodes]
    # only a path that continues over a border between two tasks is there twice
    assert len(nodes) <= len(found) <= len(nodes) + (len(packed) - 1) * max(map(len, distinct))
    assert sum(len(row.conversations) for row in packed) == len(distinct)
    for row in packed:
        for k, node in enumerate(row.nodes):
            assert node.start == (row.nodes[k - 1].end if k else 0) and -1 <= node.parent < k
            chain, at = [], k
            while at >= 0:
                chain.append(at)
                at = row.nodes[at].parent
            before = chain[:0:-1]
            assert node.position == sum(row.nodes[a].end - row.nodes[a].start for a in before)
            seen = [x for s in row.sees[k] for x in range(s.start, s.end)]
            assert seen == [x for a in before for x in range(row.nodes[a].start, row.nodes[a].end)]
            assert all(a.end < b.start for a, b in zip(row.sees[k], row.sees[k][1:]))


def test_tokens_of_a_tokenizer(spark):
    coder = tiktoken.Encoding("bytes", pat_str=r"(?s).", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    rows = conversations(3, 30)
    packed = chat.packs(chat.gathered(frame(spark, rows)),
                        encode=lambda texts: [list(t.encode()) for t in texts], most=2000).collect()
    want = {tuple(t) for _, t in turns_of(rows)}
    got = set()
    for row in packed:
        nodes, sees = [n.asDict() for n in row.nodes], [[s.asDict() for s in x] for x in row.sees]
        assert coder.decode(row.tokens) == row.text and nodes[-1]["end"] == len(row.tokens)
        learned = {x for s in row.loss for x in range(s.start, s.end)}
        for leaf in row.conversations:
            spans = chat.visible(nodes, sees, leaf.node)
            turns = Template().read(coder.decode([i for a, b in spans for i in row.tokens[a:b]]))
            got.add(tuple(turns))
            own = coder.decode([row.tokens[x] for a, b in spans for x in range(a, b) if x in learned])
            assert own == "".join(Template().escape(t) for r, t in turns if r == "assistant")
    assert got == want


def test_copies_leave_a_row_a_task(spark):
    rows = [(c, 0, "user", "same") for c in range(2000)]
    whole = chat.gathered(frame(spark, rows))
    assert chat.distinct_in_task(whole).count() <= whole.rdd.getNumPartitions()
    assert chat.packs(whole).select(F.explode("conversations")).count() == 1


def test_empty(spark):
    packed, members = chat.formatted(frame(spark, [], 1))
    assert packed.count() == 0 and chat.read_back(packed, members).count() == 0
    assert Pack(Template(), (), None).row("x")["text"] == ""
