"""Job postings: flatten pages (P4), clean (P5, F2), window and age filters
(F1, F4), phrase search (F3), newest-first paging (O3, O4), overlap dedup
(U3), insert-if-new / latest-wins merges (J1), audit columns (P7).
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.scalars import parse_iso_timestamp, ts_lit
from .dedup import dedup_first

FLAT = ["job_id", "job_title", "job_location", "job_company", "job_category",
        "job_description", "job_url", "job_created"]


def explode_pages(pages: DataFrame, results: str = "results") -> DataFrame:
    """One row per posting of every page (``inline`` keeps it in the JVM;
    empty and null ``results`` give no rows)."""
    return pages.select(F.inline(F.col(results)))


def flatten_postings(postings: DataFrame) -> DataFrame:
    """Nested posting -> flat columns.  A missing or null parent struct
    gives a null child (never an error)."""
    return postings.select(
        F.col("id").alias("job_id"),
        F.col("title").alias("job_title"),
        F.col("location.display_name").alias("job_location"),
        F.col("company.display_name").alias("job_company"),
        F.col("category.label").alias("job_category"),
        F.col("description").alias("job_description"),
        F.col("redirect_url").alias("job_url"),
        F.col("created").alias("job_created"),
    )


def clean_postings(flat: DataFrame) -> DataFrame:
    """P5 + F2 (C6): parse ``job_created`` (null on junk) and drop rows with a
    null id, title or created time; empty strings are kept.

    The instant is kept as a UTC wall clock (``timestamp_ntz``): the
    session zone is pinned to UTC by the jobs (D7)."""
    parsed = flat.withColumn("job_created",
                             parse_iso_timestamp(F.col("job_created")).cast("timestamp_ntz"))
    return parsed.dropna(subset=["job_id", "job_title", "job_created"])


def in_window(df: DataFrame, start, end, ts: str = "job_created") -> DataFrame:
    """``start <= ts <= end``, both ends inclusive.  Bounds are literals
    or columns (e.g. from a joined state row)."""
    s, e = ts_lit(start), ts_lit(end)
    return df.where(F.col(ts).between(s, e))


def max_age_days(run_ts: dt.datetime, start: dt.datetime, cap: int | None = None) -> int:
    """whole days since ``start`` plus one, optionally capped."""
    days = (run_ts - start).days + 1
    return min(days, cap) if cap is not None else days


def within_max_age(df: DataFrame, run_ts: dt.datetime, start: dt.datetime,
                   cap: int | None = None, ts: str = "job_created") -> DataFrame:
    """``ts >= run_ts - max_age_days``.  The source's 30-day cap silently
    lost longer gaps (D11), so the cap is off unless asked for."""
    days = max_age_days(run_ts, start, cap)
    return df.where(F.col(ts) >= ts_lit(run_ts - dt.timedelta(days=days)))


def phrase_filter(df: DataFrame, phrase: str, cols: list[str], whole_words: bool = False) -> DataFrame:
    """keep rows with a column of ``cols`` that contains ``phrase``,
    case-insensitively; ``whole_words`` requires non-word characters (or the
    text's ends) around it.  Every column is tested by itself: a phrase never
    spans two of them; null columns match nothing."""
    needle = phrase.lower()

    def holds(c: str) -> Column:
        text = F.coalesce(F.lower(F.col(c)), F.lit(""))
        return text.rlike(phrase_pattern(needle)) if whole_words else text.contains(F.lit(needle))
    return df.where(functools.reduce(operator.or_, [holds(c) for c in cols]))


def phrase_pattern(phrase: str) -> str:
    """Regex for a whole-word phrase; the boundary is spelled out (ASCII word
    characters) so Java and RE2 engines agree."""
    import re
    return r"(^|[^a-z0-9_])" + re.escape(phrase.lower()) + r"($|[^a-z0-9_])"


def latest_page(df: DataFrame, page: int = 1, page_size: int = 50,
                ts: str = "job_created", key: str = "job_id") -> DataFrame:
    """O3 + O4: newest first (key as tie-break), one page.  A top-k: each task
    keeps its best ``page*page_size`` rows, so nothing global is sorted."""
    ordered = df.orderBy(F.col(ts).desc_nulls_last(), F.col(key).asc_nulls_last())
    return ordered.offset((page - 1) * page_size).limit(page_size) if page > 1 \
        else ordered.limit(page_size)


@dataclass(frozen=True)
class Cursor:
    """Where a page ended: its last row's time and key, and how many rows with just these came so far."""
    ts: dt.datetime | None
    key: object
    seen: int


def page_after(df: DataFrame, cursor: Cursor | None = None, page_size: int = 50,
               ts: str = "job_created", key: str = "job_id") -> DataFrame:
    """O4 by cursor: the rows that follow ``cursor`` in the order of ``latest_page``.

    The cursor is a filter on (ts, key) that reaches the scan, then a top-k:
    every task keeps ``page_size`` rows (and those of the cursor's own time and key),
    whatever the page's number.  Rows that agree in both come in the order of
    a hash of the other columns; none is lost or shown twice, equal rows included.
    ``ts`` is a ``timestamp_ntz``.
    """
    rest = [c for c in df.columns if c not in (ts, key)]
    order = [F.col(ts).desc_nulls_last(), F.col(key).asc_nulls_last(), *([F.xxhash64(*rest)] if rest else [])]
    if cursor is None:
        return df.orderBy(*order).limit(page_size)
    no_key = F.col(key).isNull()
    key_on = no_key if cursor.key is None else (F.col(key) >= F.lit(cursor.key)) | no_key
    if cursor.ts is None:
        on = F.col(ts).isNull() & key_on
    else:
        at = ts_lit(cursor.ts).cast(df.schema[ts].dataType)
        on = (F.col(ts) < at) | F.col(ts).isNull() | ((F.col(ts) == at) & key_on)
    return df.where(on).orderBy(*order).offset(cursor.seen).limit(page_size)


def cursor_of(page: list[Row], before: Cursor | None = None, ts: str = "job_created",
              key: str = "job_id") -> Cursor | None:
    """The cursor behind a page (its collected rows, at most a page's size); ``before`` is the one that led to it."""
    if not page:
        return before
    last = (page[-1][ts], page[-1][key])
    own = sum((r[ts], r[key]) == last for r in page)
    if before is not None and (before.ts, before.key) == last:
        own += before.seen
    return Cursor(*last, own)


def union_pages(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; columns missing on one side are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dedup_postings(df: DataFrame, key: str = "job_id", ts: str = "job_created",
                   *tie_break: str) -> DataFrame:
    """One row per posting; the latest ``ts`` wins (ties broken by the
    remaining columns, ascending, so the result is deterministic)."""
    rest = list(tie_break) or [c for c in df.columns if c not in (key, ts)]
    return dedup_first(df, [key], [(ts, "desc")] + rest)


def with_audit(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """``extraction_date`` / ``extraction_timestamp`` of the run (one value
    passed in, never a per-row clock)."""
    return (df.withColumn("extraction_date", F.lit(run_ts.date()))
              .withColumn("extraction_timestamp", ts_lit(run_ts)))


def upsert_latest(existing: DataFrame, batch: DataFrame, key: str = "job_id",
                  ts: str = "job_created", audit_ts: str = "extraction_timestamp") -> DataFrame:
    """J1 latest-wins: stored rows and the batch, one row per key, newest
    ``ts`` first, then the newest load."""
    both = union_pages(existing, batch)
    rest = [c for c in both.columns if c not in (key, ts, audit_ts)]
    return dedup_first(both, [key], [(ts, "desc"), (audit_ts, "desc")] + rest)
