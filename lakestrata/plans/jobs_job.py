"""One incremental postings run as a single Spark DAG plus a state commit.

    state (S8) -> landed files not in the ledger (S5) -> flatten/clean (C6) -> window (F1) [-> age cap (F4)]
    + postings held for this run -> dedup (U3) -> audit (P7) -> insert-if-new append (J1 + K4)
    -> ledger -> state (K6)

A run opens only files that are new or changed since the ledger has them.
Postings dated after the run are held and taken up by the run over the same landing that
reaches them.  Malformed pages go to a quarantine table, once; when their file has changed
or gone, the files that landed since are read for its window.  Whether the state moves on over them
is a setting; postings that the cleaning rejects are counted in the receipt.

The state advances only after the append succeeded (D6), the ledger is written in between: a crash
before it is repaired by the next run, which reads the same files, and whose
anti join skips what was already stored.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import JobsConfig
from ..functions.scalars import ts_lit
from ..operators import jobs as J
from ..operators.state import commit_state, current_state
from ..schemas import CORRUPT_COLUMN
from ..session import checkpoint_root, ensure_utc
from ..sources import held, ledger, raw_json, tables


def read_state(spark: SparkSession, table: str, state_id: str, run_ts: dt.datetime,
               lookback_days: int) -> dict:
    """The pipeline's current state, or the first-run default."""
    if spark.catalog.tableExists(table):
        rows = current_state(spark.table(table).where(F.col("state_id") == state_id)).collect()
        if rows:
            return rows[0].asDict()
    return {"state_id": state_id, "version": 0, "total_jobs_extracted": 0,
            "last_extraction_time": run_ts - dt.timedelta(days=lookback_days), "created_at": None}


def quarantine_pages(spark: SparkSession, cfg: JobsConfig, broken: DataFrame, run_ts: dt.datetime) -> tuple[int, DataFrame]:
    """Malformed pages go to the quarantine table with their text and file, unless a run that died has put
    them there; the number of new ones, and the files (file) that hold any."""
    name = f"{cfg.database}.{cfg.quarantine_table}"
    rows = broken.select(F.col(CORRUPT_COLUMN).alias("record"), F.col("_metadata.file_path").alias("file"),
                         F.col("_metadata.file_modification_time").alias("modified"),
                         F.col("results").isNull().alias("unread"), ts_lit(run_ts).alias("run_ts"))
    checkpoint_root(spark)
    rows = rows.checkpoint()
    new = rows
    if tables.table_exists(spark, name):
        new = rows.join(spark.table(name).select("file", "modified").distinct(), ["file", "modified"], "left_anti")
    obs = Observation("quarantined_pages")
    new.observe(obs, F.count(F.lit(1)).alias("n")).write.format(cfg.table_format).mode("append").saveAsTable(name)
    return int(obs.get.get("n") or 0), rows.select("file").distinct()


def run_jobs(spark: SparkSession, cfg: JobsConfig, pages_path: str, run_ts: dt.datetime,
             db_location: str | None = None) -> dict:
    ensure_utc(spark)
    tables.ensure_database(spark, cfg.database, db_location)
    state_table = f"{cfg.database}.{cfg.state_table}"
    jobs_table = f"{cfg.database}.{cfg.table}"
    ledger_table = f"{cfg.database}.{cfg.ledger_table}"
    held_path = held.folder(spark, jobs_table, pages_path)
    checkpoint_root(spark)

    state = read_state(spark, state_table, cfg.state_id, run_ts, cfg.lookback_days)
    start = state["last_extraction_time"] - dt.timedelta(hours=cfg.overlap_hours)
    end = run_ts

    known = ledger.entries(spark, ledger_table, pages_path)
    files = ledger.listing(spark, pages_path)
    old_bad = ledger.still_bad(files, known).count()
    fresh = ledger.fresh(files, known).checkpoint()
    names = ledger.paths(fresh)
    replaced = ledger.gone_bad(files, known).where(F.lit(bool(names))).checkpoint()
    retry_from = replaced.agg(F.min("window_start")).first()[0]

    pages, broken = raw_json.split_corrupt(raw_json.read_job_pages(spark, names))
    quarantined, bad_files = quarantine_pages(spark, cfg, broken, run_ts)
    seen, good = Observation("postings_seen"), Observation("postings_good")
    flat = J.flatten_postings(J.explode_pages(pages)).observe(seen, F.count(F.lit(1)).alias("n"))
    clean = J.clean_postings(flat).observe(good, F.count(F.lit(1)).alias("n"))
    # what stands for files that could not be read whole counts for the window these were read for
    since = min(start, retry_from) if retry_from is not None else start
    clean = clean.where(F.col("job_created") >= ts_lit(since)).checkpoint()
    later = clean.where(F.col("job_created") > ts_lit(end))
    if not later.isEmpty():
        held.hold(later, held_path, "job_created", fmt=cfg.table_format)
    batch = J.in_window(clean, since, end)
    reached = held.waiting(spark, held_path, clean.schema, "job_created", end, fmt=cfg.table_format)
    if reached is not None:
        batch = batch.unionByName(reached)
    if cfg.filter_phrase:
        batch = J.phrase_filter(batch, cfg.search_phrase, ["job_title", "job_description"])
    if cfg.max_age_cap_days is not None:
        batch = J.within_max_age(batch, run_ts, start, cfg.max_age_cap_days)
    batch = J.with_audit(J.dedup_postings(batch), run_ts)

    receipt = tables.append_new(batch, jobs_table, "job_id", partition_by=["extraction_date"],
                                run_marker={"extraction_date": run_ts.date(),
                                            "extraction_timestamp": run_ts},
                                fmt=cfg.table_format, max_records_per_file=cfg.max_rows_per_file,
                                bucket_by=(cfg.key_buckets, "job_id") if cfg.key_buckets else None)
    ledger.enter(fresh, bad_files, replaced, ledger_table, pages_path, since, run_ts, fmt=cfg.table_format)
    rejected = int(seen.get.get("n") or 0) - int(good.get.get("n") or 0)
    advance = cfg.advance_over_quarantined or not (quarantined or old_bad)
    version = commit_state(spark, state_table, cfg.state_id, state["version"], run_ts,
                           receipt.new_jobs, fmt=cfg.table_format) if advance else state["version"]
    if advance:
        held.clear(spark, held_path, run_ts)
    return {"quarantined_pages": quarantined, "rejected_postings": rejected, "state_advanced": advance,
            "files_read": len(names), "files_still_bad": old_bad,
            "jobs_processed": receipt.new_jobs, "files_written": receipt.files_written,
            "table_updated": receipt.table_updated, "version": version,
            "extraction_window_start": start, "extraction_window_end": end}
