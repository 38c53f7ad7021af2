"""Secret scan over a trigram inverted index, in DataFrame functions only.

Each rule's regex gives a Boolean trigram query: literals that every match
must hold, as an OR of conjunctions of trigrams.  Postings (trigram, document)
are made for the trigrams that the rules ask for; intersecting them gives the
candidates of each rule, whose whole text the regex then verifies.  A rule
without mandatory trigrams scans every text.

Cases: null text is empty; null ids and repeated ids are told apart by their
text, rows that repeat both are scanned alike; no match gives empty spans;
ties between kinds at one start go by the rules' order; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass
from re import _constants as C
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import KEY, keyed, with_key

MOST_STRINGS = 8            # a run of literals stands for at most so many strings


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share; ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int


#: Fixed values of the contract.
RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)


def _strings(node) -> set[str] | None:
    """All strings that a parsed node matches, if few; lower case."""
    kind, arg = node
    if kind is C.LITERAL:
        return {chr(arg).lower()}
    if kind is C.IN:
        if any(k is not C.LITERAL for k, _ in arg):
            return None
        return {chr(v).lower() for _, v in arg}
    if kind is C.SUBPATTERN:
        return _joined([_strings(x) for x in arg[3]])
    if kind is C.BRANCH:
        parts = [_joined([_strings(x) for x in branch]) for branch in arg[1]]
        out = None if None in parts else set().union(*parts)
        return out if out is not None and len(out) <= MOST_STRINGS else None
    if kind is C.MAX_REPEAT and arg[:2] == (0, 1):
        inner = _joined([_strings(x) for x in arg[2]])
        return None if inner is None else inner | {""}
    return None


def _joined(parts: list[set[str] | None]) -> set[str] | None:
    out = {""}
    for p in parts:
        if p is None or len(out) * len(p) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in p}
    return out


def trigram_query(pattern: str) -> list[list[list[str]]]:
    """AND of ORs of ANDs of trigrams (lower case) that every match holds; []: none is mandatory.

    Runs of literals become the strings they may stand for; a run that may be
    shorter than three characters asks for nothing.
    """
    clauses: list[set[str]] = []
    run = {""}
    for node in _parser.parse(pattern):
        s = _strings(node)
        if s is None or len(run) * len(s) > MOST_STRINGS:
            clauses.append(run)
            run = s if s is not None else {""}
        else:
            run = {a + b for a in run for b in s}
    clauses.append(run)
    grams = lambda s: sorted({s[i:i + 3] for i in range(len(s) - 2)})
    return [[grams(s) for s in sorted(c)] for c in clauses if min(map(len, c)) >= 3]


def postings(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(trigram, __kid, __kh): the inverted index over the trigrams that the rules ask for."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.pattern) for conj in clause for t in conj})
    low = F.lower("__text")
    found = [F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in wanted]
    held = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    return keyed(docs, id_col, text_col).select(F.explode(held).alias("trigram"), *KEY).distinct()


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(__kid, __kh, one boolean per kind): postings intersected and united as the rules' queries say."""
    held = index.groupBy(*KEY).agg(F.collect_set("trigram").alias("t"))     # at most the rules' trigrams

    def holds(rule: Rule) -> Column:
        every = [functools.reduce(operator.or_, [
            functools.reduce(operator.and_, [F.array_contains("t", g) for g in conj]) for conj in clause])
            for clause in trigram_query(rule.pattern)]
        return functools.reduce(operator.and_, every) if every else F.lit(True)

    return held.select(*KEY, *[holds(r).alias(f"__may_{r.kind}") for r in rules])


def _spans(rule: Rule, at: int, text: str) -> Column:
    """Sorted (start, at, end) of a rule's matches in a column, in code points.

    Texts between the matches (split) and the matches themselves, laid end to
    end, give the positions.
    """
    p = "'" + _tight(rule).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr(f"""
      aggregate(
        arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0),
                   regexp_extract_all({text}, {p}, {rule.group})),
        named_struct('p', 0, 's', cast(array() AS array<struct<start:int,kind:int,end:int>>)),
        (a, x) -> named_struct(
          'p', a.p + char_length(x.`0`) + coalesce(char_length(x.`1`), 0),
          's', if(coalesce(char_length(x.`2`), 0) >= {rule.least},
                  concat(a.s, array(named_struct('start', a.p + char_length(x.`0`), 'kind', {at},
                                                 'end', a.p + char_length(x.`0`) + char_length(x.`1`)))),
                  a.s)),
        a -> a.s)""")


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``__found``: its spans (start, kind index, end), sorted.

    A text without any match is not split.
    """
    may = candidates(postings(docs, rules, id_col, text_col), rules)
    rows = (with_key(docs, id_col, text_col).join(may, KEY, "left")
            .withColumn("__text", F.coalesce(F.col(text_col), F.lit(""))))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    found = []
    for i, r in enumerate(rules):
        may = F.coalesce(F.col(f"__may_{r.kind}"), F.lit(False)) if trigram_query(r.pattern) else F.lit(True)
        rows = rows.withColumn(f"__in_{r.kind}", F.when(
            may & F.col("__text").rlike(_tight(r)), _spans(r, i, "__text")).otherwise(none))
        found.append(f"__in_{r.kind}")
    return (rows.withColumn("__found", F.array_sort(F.concat(*found)))
            .drop(*KEY, "__text", *found, *[f"__may_{r.kind}" for r in rules]))


def _tight(rule: Rule) -> str:
    """The pattern with its closing ``[..]+`` raised to the least length, where that gives the same spans.

    A literal head and one closing class: a match that is too short ends with
    the run of the class, and what starts later in that run is shorter still.
    """
    if rule.group == 0 and rule.pattern.endswith("]+"):
        head = rule.pattern[:rule.pattern.index("[")]
        return f"{rule.pattern[:-1]}{{{rule.least - len(head)},}}"
    return rule.pattern
