"""Registered queries of the incremental postings flow on the ``events`` stand-in."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import jobs as J
from ..operators import phrases as PH
from ..operators import state as ST
from ..session import ensure_utc, scratch_path
from ..sources import raw_json, tables
from ..sources.testdata import table
from . import oracle as O
from . import standins
from .registry import register

WINDOW_START = dt.datetime(2024, 1, 10)
WINDOW_END = dt.datetime(2024, 1, 20, 12)
RUN1_TS = dt.datetime(2024, 1, 15, 12)
RUN2_TS = dt.datetime(2024, 1, 31)
STATE_AS_OF = dt.datetime(2024, 1, 20, 23, 59, 59)
STATE_RUN_TS = dt.datetime(2024, 1, 25)
DEFAULT_RUN_TS = dt.datetime(2024, 2, 1)
AGE_RUN_TS = dt.datetime(2024, 1, 31)
AGE_START = dt.datetime(2024, 1, 20, 6)
PHRASE = "of the"
SENTENCE_END = "the. the"


def key_buckets(spark: SparkSession) -> int:
    """Buckets for tables keyed by job_id: the session's shuffle parallelism,
    so the stored side of the insert-if-new join is read pre-partitioned."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_database(spark: SparkSession, name: str) -> str:
    """A fresh catalog database located in the shared scratch folder."""
    db = f"ls_{name}_{uuid.uuid4().hex[:8]}"
    tables.ensure_database(spark, db, scratch_path(spark, db))
    return db


def flat_postings(spark, sf_dir) -> DataFrame:
    return J.flatten_postings(standins.postings(table(spark, sf_dir, "events")))


def clean_postings(spark, sf_dir) -> DataFrame:
    ensure_utc(spark)
    return J.clean_postings(flat_postings(spark, sf_dir))


@register("jobs_flatten", "WITH" + O.POSTINGS_CTE + "\nSELECT * FROM flat")
def jobs_flatten(spark, sf_dir):
    """S5 + P4: pages landed as JSON, read back with the page schema, one row
    per posting, flattened."""
    landing = scratch_path(spark, "job_pages")
    standins.job_pages(table(spark, sf_dir, "events")).drop("page_no").write.json(landing)
    pages = raw_json.read_job_pages(spark, landing)
    return J.flatten_postings(J.explode_pages(pages))


@register("jobs_clean", "WITH" + O.POSTINGS_CTE + "\nSELECT * FROM clean")
def jobs_clean(spark, sf_dir):
    return clean_postings(spark, sf_dir)


@register("jobs_union_pages", "WITH" + O.POSTINGS_CTE + """
SELECT * FROM slice_a UNION ALL BY NAME SELECT * FROM slice_b""")
def jobs_union_pages(spark, sf_dir):
    a, b = standins.overlap_slices(clean_postings(spark, sf_dir))
    return J.union_pages(a, b)


@register("jobs_window", "WITH" + O.POSTINGS_CTE + f"""
SELECT * FROM clean
WHERE job_created BETWEEN TIMESTAMP '{WINDOW_START}' AND TIMESTAMP '{WINDOW_END}'""")
def jobs_window(spark, sf_dir):
    return J.in_window(clean_postings(spark, sf_dir), WINDOW_START, WINDOW_END)


@register("jobs_max_age", "WITH" + O.POSTINGS_CTE + f"""
SELECT * FROM clean
WHERE job_created >= TIMESTAMP '{AGE_RUN_TS}' - to_days(CAST(
      floor(epoch(TIMESTAMP '{AGE_RUN_TS}' - TIMESTAMP '{AGE_START}') / 86400) + 1 AS INTEGER))""")
def jobs_max_age(spark, sf_dir):
    return J.within_max_age(clean_postings(spark, sf_dir), AGE_RUN_TS, AGE_START, cap=None)


@register("jobs_phrase", f"""
SELECT doc_id, lang, source, n_chars,
       regexp_matches(lower(text), '(^|[^a-z0-9_]){PHRASE}($|[^a-z0-9_])') AS whole_words
FROM documents WHERE contains(lower(text), '{PHRASE}')""")
def jobs_phrase(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    hits = J.phrase_filter(docs, PHRASE, ["text"])
    return hits.select("doc_id", "lang", "source", "n_chars",
                       F.lower("text").rlike(J.phrase_pattern(PHRASE)).alias("whole_words"))


@register("jobs_phrase_index", f"""
SELECT doc_id, lang, source, n_chars, '{PHRASE}' AS phrase FROM documents
WHERE regexp_matches(lower(text), '(^|[^a-z0-9_]){PHRASE}($|[^a-z0-9_])')
UNION ALL
SELECT doc_id, lang, source, n_chars, '{SENTENCE_END}' FROM documents
WHERE regexp_matches(lower(text), '(^|[^a-z0-9_]){SENTENCE_END.replace(".", "[.]")}($|[^a-z0-9_])')""")
def jobs_phrase_index(spark, sf_dir):
    """F3 by positions: the index of all texts is built once and two phrases are looked up in it."""
    docs = table(spark, sf_dir, "documents")
    path, parts = scratch_path(spark, "phrases"), key_buckets(spark)
    PH.write_index(docs, path, "doc_id", ["text"], parts)
    return J.union_pages(*[
        PH.holding(docs, PH.search(spark, path, phrase, parts, "long"), "doc_id", ["text"])
        .select("doc_id", "lang", "source", "n_chars", F.lit(phrase).alias("phrase"))
        for phrase in (PHRASE, SENTENCE_END)])


@register("jobs_latest_topk", "WITH" + O.POSTINGS_CTE + """
SELECT * FROM clean ORDER BY job_created DESC, job_id LIMIT 50 OFFSET 50""")
def jobs_latest_topk(spark, sf_dir):
    return J.latest_page(clean_postings(spark, sf_dir), page=2, page_size=50)


@register("jobs_cursor_pages", "WITH" + O.POSTINGS_CTE + """,
n AS (SELECT *, row_number() OVER (ORDER BY job_created DESC, job_id) AS rn FROM clean)
SELECT * EXCLUDE (rn), CAST((rn - 1) // 50 + 1 AS INTEGER) AS page FROM n WHERE rn <= 150""")
def jobs_cursor_pages(spark, sf_dir):
    """O4 by cursor: three pages of the stored postings, each found from the end of the one before."""
    path = scratch_path(spark, "postings_pages")
    clean_postings(spark, sf_dir).write.parquet(path)
    stored, cursor, pages = spark.read.parquet(path), None, []
    for n in (1, 2, 3):
        page = J.page_after(stored, cursor)
        cursor = J.cursor_of(page.collect(), cursor)
        pages.append(page.withColumn("page", F.lit(n)))
    return J.union_pages(*pages)


@register("jobs_overlap_dedup", "WITH" + O.POSTINGS_CTE + """,
u AS (SELECT * FROM slice_a UNION ALL BY NAME SELECT * FROM slice_b)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY job_created DESC) AS rn FROM u)
WHERE rn = 1""")
def jobs_overlap_dedup(spark, sf_dir):
    a, b = standins.overlap_slices(clean_postings(spark, sf_dir))
    return J.dedup_postings(J.union_pages(a, b))


AUDIT_SQL = """
stored AS (
  SELECT *, DATE '{d1}' AS extraction_date, TIMESTAMP '{t1}' AS extraction_timestamp FROM slice_a),
batch AS (
  SELECT *, DATE '{d2}' AS extraction_date, TIMESTAMP '{t2}' AS extraction_timestamp FROM slice_b)
""".format(d1=RUN1_TS.date(), t1=RUN1_TS, d2=RUN2_TS.date(), t2=RUN2_TS)


@register("jobs_upsert", "WITH" + O.POSTINGS_CTE + "," + AUDIT_SQL + """
SELECT * FROM stored
UNION ALL BY NAME
SELECT * FROM batch WHERE job_id NOT IN (SELECT job_id FROM stored)""")
def jobs_upsert(spark, sf_dir):
    """J1 + K4 + P7: stored table (run 1), then an insert-if-new append of an
    overlapping batch (run 2); the result is the table as stored."""
    a, b = standins.overlap_slices(clean_postings(spark, sf_dir))
    db = scratch_database(spark, "jobs")
    name = f"{db}.postings"
    # run 1 creates the table with the full column set of later batches
    first = J.with_audit(a.withColumn("job_salary", F.lit(None).cast("double")), RUN1_TS)
    buckets = (key_buckets(spark), "job_id")
    tables.append_new(first, name, "job_id", partition_by=["extraction_date"],
                      max_records_per_file=50000, bucket_by=buckets)
    tables.append_new(J.with_audit(b, RUN2_TS), name, "job_id",
                      partition_by=["extraction_date"], max_records_per_file=50000,
                      bucket_by=buckets)
    return tables.read_table(spark, name)


@register("jobs_upsert_latest", "WITH" + O.POSTINGS_CTE + "," + AUDIT_SQL + """,
u AS (SELECT * FROM stored UNION ALL BY NAME SELECT * FROM batch)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id
                               ORDER BY job_created DESC, extraction_timestamp DESC) AS rn FROM u)
WHERE rn = 1""")
def jobs_upsert_latest(spark, sf_dir):
    a, b = standins.overlap_slices(clean_postings(spark, sf_dir))
    return J.upsert_latest(J.with_audit(a, RUN1_TS), J.with_audit(b, RUN2_TS))


@register("jobs_upsert_stored", "WITH" + O.POSTINGS_CTE + "," + AUDIT_SQL + """,
u AS (SELECT * FROM stored UNION ALL BY NAME SELECT * FROM batch)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY job_id
                               ORDER BY job_created DESC, extraction_timestamp DESC) AS rn FROM u)
WHERE rn = 1""")
def jobs_upsert_stored(spark, sf_dir):
    """J1 latest-wins into a stored table: slice A, then slice B (the overlap re-fetched with later
    times), then slice A again, which is older and changes nothing; the table as stored."""
    a, b = standins.overlap_slices(clean_postings(spark, sf_dir))
    a = a.withColumn("job_salary", F.lit(None).cast("double"))
    path, parts = scratch_path(spark, "postings_latest"), key_buckets(spark)
    for rows, run_ts in ((a, RUN1_TS), (b, RUN2_TS), (a, RUN1_TS)):
        tables.upsert_latest_rows(J.with_audit(rows, run_ts), path, "job_id", ["job_created", "extraction_timestamp"], parts)
    schema = J.with_audit(a, RUN1_TS).schema
    return spark.read.schema(schema).parquet(path).drop(tables.part_column(parts))


@register("load_receipt", "WITH" + O.POSTINGS_CTE + """,
fresh AS (SELECT count(*) AS n FROM slice_b WHERE job_id NOT IN (SELECT job_id FROM slice_a))
SELECT 1 AS run, (SELECT count(*) FROM slice_a) AS new_jobs, (SELECT count(*) FROM slice_a) > 0 AS wrote_files,
       (SELECT count(*) FROM slice_a) > 0 AS table_updated
UNION ALL SELECT 2, n, n > 0, n > 0 FROM fresh
UNION ALL SELECT 3, 0, false, false""")
def load_receipt(spark, sf_dir):
    """K5: receipts of three loads -- slice A, slice B (only its new ids),
    slice B again (nothing new); the exact file counts are checked in the tests."""
    a, b = standins.overlap_slices(clean_postings(spark, sf_dir))
    db = scratch_database(spark, "receipt")
    name = f"{db}.postings"
    out = []
    a = a.withColumn("job_salary", F.lit(None).cast("double"))
    for run, (batch, ts) in enumerate([(a, RUN1_TS), (b, RUN2_TS),
                                       (b, RUN2_TS + dt.timedelta(days=1))], start=1):
        r = tables.append_new(J.with_audit(batch, ts), name, "job_id",
                              partition_by=["extraction_date"],
                              run_marker={"extraction_date": ts.date(), "extraction_timestamp": ts},
                              bucket_by=(key_buckets(spark), "job_id"))
        out.append((run, r.new_jobs, r.files_written > 0, r.table_updated))
    return spark.createDataFrame(out, "run int, new_jobs long, wrote_files boolean, table_updated boolean")


@register("state_current", "WITH" + O.STATE_CTE + """
SELECT * FROM state QUALIFY version = max(version) OVER (PARTITION BY state_id)""")
def state_current(spark, sf_dir):
    return ST.current_state(standins.control_table(table(spark, sf_dir, "events")))


@register("run_totals", "WITH" + O.STATE_CTE + """
SELECT state_id, version, rows_processed,
       CAST(sum(rows_processed) OVER (PARTITION BY state_id ORDER BY version
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_jobs_extracted
FROM runs""")
def run_totals(spark, sf_dir):
    runs = standins.pipeline_runs(table(spark, sf_dir, "events"))
    return ST.run_totals(runs.select("state_id", "version", "rows_processed"))


@register("state_default", "WITH" + O.STATE_CTE + f""",
requested AS (SELECT DISTINCT 'jobs_' || event_type AS state_id FROM events
              UNION SELECT 'jobs_unknown'),
cur AS (SELECT * FROM state QUALIFY version = max(version) OVER (PARTITION BY state_id))
SELECT r.state_id, coalesce(c.version, 0) AS version,
       coalesce(c.last_extraction_time, TIMESTAMP '{DEFAULT_RUN_TS}' - INTERVAL 7 DAY) AS last_extraction_time,
       coalesce(c.total_jobs_extracted, 0) AS total_jobs_extracted,
       c.version IS NULL AS is_default
FROM requested r LEFT JOIN cur c USING (state_id)""")
def state_default(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    requested = (ev.select(F.concat(F.lit("jobs_"), "event_type").alias("state_id"))
                 .union(spark.range(1).select(F.lit("jobs_unknown").alias("state_id")))
                 .distinct())
    return ST.with_defaults(requested, standins.control_table(ev), DEFAULT_RUN_TS, 7)


@register("jobs_window_from_state", "WITH" + O.POSTINGS_CTE + "," + O.STATE_CTE + f""",
state_asof AS (SELECT state_id, arg_max(last_extraction_time, version) AS last_extraction_time
         FROM state WHERE updated_at <= TIMESTAMP '{STATE_AS_OF}' GROUP BY state_id)
SELECT 'jobs_' || c.job_category AS state_id, c.*,
       a.last_extraction_time - INTERVAL 12 HOUR AS window_start,
       TIMESTAMP '{STATE_RUN_TS}' AS window_end
FROM clean c JOIN state_asof a ON a.state_id = 'jobs_' || c.job_category
WHERE c.job_created BETWEEN a.last_extraction_time - INTERVAL 12 HOUR AND TIMESTAMP '{STATE_RUN_TS}'""")
def jobs_window_from_state(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    state = ST.state_as_of(standins.control_table(ev), STATE_AS_OF)
    batch = clean_postings(spark, sf_dir).withColumn(
        "state_id", F.concat(F.lit("jobs_"), F.col("job_category")))
    return ST.window_from_state(batch, state, STATE_RUN_TS, overlap_hours=12)


INC_RUN1 = dt.datetime(2024, 1, 15, 12)
INC_RUN2 = dt.datetime(2024, 1, 31)


@register("jobs_incremental_run", "WITH" + O.POSTINGS_CTE + f""",
run1 AS (
  SELECT *, DATE '{INC_RUN1.date()}' AS extraction_date, TIMESTAMP '{INC_RUN1}' AS extraction_timestamp
  FROM clean
  WHERE job_created BETWEEN TIMESTAMP '{INC_RUN1}' - INTERVAL 7 DAY - INTERVAL 12 HOUR
                        AND TIMESTAMP '{INC_RUN1}'),
run2 AS (
  SELECT *, DATE '{INC_RUN2.date()}' AS extraction_date, TIMESTAMP '{INC_RUN2}' AS extraction_timestamp
  FROM clean
  WHERE job_created BETWEEN TIMESTAMP '{INC_RUN1}' - INTERVAL 12 HOUR AND TIMESTAMP '{INC_RUN2}'
    AND job_id NOT IN (SELECT job_id FROM run1))
SELECT * FROM run1 UNION ALL SELECT * FROM run2""")
def jobs_incremental_run(spark, sf_dir):
    """C7 end to end: pages landed as JSON, two scheduled runs of
    ``run_jobs``.  Run 1 has no state (7 days back, minus the 12 h overlap);
    run 2 starts 12 h before run 1's high-water mark, and the overlap it
    re-reads is skipped by insert-if-new.  Returns the stored table."""
    from ..config import JobsConfig
    from .jobs_job import run_jobs
    landing = scratch_path(spark, "job_pages_runs")
    standins.job_pages(table(spark, sf_dir, "events")).drop("page_no").write.json(landing)
    db = f"ls_incremental_{uuid.uuid4().hex[:8]}"
    cfg = JobsConfig(database=db, key_buckets=key_buckets(spark))
    location = scratch_path(spark, db)
    for run_ts in (INC_RUN1, INC_RUN2):
        run_jobs(spark, cfg, landing, run_ts, db_location=location)
    return tables.read_table(spark, f"{db}.{cfg.table}")


@register("jobs_quarantine", "WITH" + O.POSTINGS_CTE + f""",
pages AS (SELECT *, event_id // 50 AS page_no FROM ev),
good AS (SELECT * FROM pages WHERE page_no % 5 <> 2),
kept AS (SELECT * FROM good WHERE k NOT IN (0, 1, 2, 4))
SELECT (SELECT count(*) FROM kept WHERE ts BETWEEN TIMESTAMP '{INC_RUN2}' - INTERVAL 180 HOUR
                                               AND TIMESTAMP '{INC_RUN2}') AS stored,
       (SELECT count(DISTINCT page_no) FROM pages WHERE page_no % 5 = 2) AS quarantined,
       (SELECT count(*) FROM good) - (SELECT count(*) FROM kept) AS rejected,
       (SELECT count(DISTINCT page_no) FROM pages WHERE page_no % 5 = 2) = 0 AS state_advanced""")
def jobs_quarantine(spark, sf_dir):
    """C7 over a landing in which every fifth page is cut short: the good
    postings are stored, the broken pages are quarantined and counted, so are
    the postings that cleaning rejects, and the state does not move over the loss."""
    from ..config import JobsConfig
    from .jobs_job import run_jobs
    landing = scratch_path(spark, "job_pages_broken")
    text = F.to_json(F.struct("results"))
    pages = standins.job_pages(table(spark, sf_dir, "events"))
    pages.select(F.when(F.col("page_no") % 5 == 2, F.substring(text, 1, 40)).otherwise(text).alias("value")
                 ).write.text(landing)
    db = f"ls_quarantine_{uuid.uuid4().hex[:8]}"
    cfg = JobsConfig(database=db, advance_over_quarantined=False)
    receipt = run_jobs(spark, cfg, landing, INC_RUN2, db_location=scratch_path(spark, db))
    lost = spark.table(f"{db}.{cfg.quarantine_table}").agg(F.count("record").alias("quarantined"))
    stored = spark.table(f"{db}.{cfg.table}").agg(F.count(F.lit(1)).alias("stored"))
    counts = {"stored": stored.first()[0], "quarantined": lost.first()[0]}
    return spark.createDataFrame(
        [(counts["stored"], counts["quarantined"], receipt["rejected_postings"], receipt["state_advanced"])],
        "stored long, quarantined long, rejected long, state_advanced boolean")


RETRY_RUN = dt.datetime(2024, 2, 10)


@register("jobs_ledger_runs", "WITH" + O.POSTINGS_CTE + f""",
pages AS (SELECT *, event_id // 50 AS page_no FROM ev),
kept AS (SELECT * FROM pages WHERE k NOT IN (0, 1, 2, 4)),
one AS (SELECT * FROM kept WHERE page_no % 5 <> 2 AND ts BETWEEN TIMESTAMP '{INC_RUN1}' - INTERVAL 180 HOUR AND TIMESTAMP '{INC_RUN1}'),
two AS (SELECT * FROM kept WHERE page_no % 5 <> 2 AND ts > TIMESTAMP '{INC_RUN1}' AND ts <= TIMESTAMP '{INC_RUN2}'),
three AS (SELECT * FROM kept WHERE page_no % 5 = 2 AND ts BETWEEN TIMESTAMP '{INC_RUN1}' - INTERVAL 180 HOUR AND TIMESTAMP '{RETRY_RUN}'
          UNION ALL SELECT * FROM kept WHERE page_no % 5 <> 2 AND ts > TIMESTAMP '{INC_RUN2}' AND ts <= TIMESTAMP '{RETRY_RUN}'),
bad AS (SELECT count(DISTINCT page_no) AS n FROM pages WHERE page_no % 5 = 2)
SELECT 1 AS run, (SELECT count(*) FROM one) AS stored, (SELECT n FROM bad) AS quarantined, true AS read_files,
       CAST(1 AS BIGINT) AS version, (SELECT n FROM bad) AS in_quarantine
UNION ALL SELECT 2, (SELECT count(*) FROM two), 0, false, 2, (SELECT n FROM bad)
UNION ALL SELECT 3, (SELECT count(*) FROM three), 0, true, 3, (SELECT n FROM bad)""")
def jobs_ledger_runs(spark, sf_dir):
    """C7 with the ledger: three runs over one landing.  Run 1 meets cut pages in their own files and quarantines
    them, and the window moves on.  Run 2 opens no file, quarantines nothing again, and stores the postings that run 1 held
    for it.  Then the bad pages are landed whole in place of their files: run 3 reads just these, for the window of run 1."""
    from ..config import JobsConfig
    from .jobs_job import run_jobs
    landing = scratch_path(spark, "job_pages_ledger")
    text = F.to_json(F.struct("results"))
    pages = standins.job_pages(table(spark, sf_dir, "events"))
    bad = F.col("page_no") % 5 == 2
    pages.where(~bad).select(text.alias("value")).write.text(f"{landing}/good")
    pages.where(bad).select(F.substring(text, 1, 40).alias("value")).write.text(f"{landing}/late")
    db = f"ls_ledger_{uuid.uuid4().hex[:8]}"
    cfg = JobsConfig(database=db)
    location, out = scratch_path(spark, db), []
    for run, run_ts in enumerate((INC_RUN1, INC_RUN2, RETRY_RUN), 1):
        if run == 3:        # the bad pages are landed whole, in place of their files
            pages.where(bad).select(text.alias("value")).write.mode("overwrite").text(f"{landing}/late")
        receipt = run_jobs(spark, cfg, f"{landing}/*", run_ts, db_location=location)
        lost = spark.table(f"{db}.{cfg.quarantine_table}").count()
        out.append((run, receipt["jobs_processed"], receipt["quarantined_pages"], receipt["files_read"] > 0,
                    receipt["version"], lost))
    return spark.createDataFrame(out, "run int, stored long, quarantined long, read_files boolean, version long, in_quarantine long")
