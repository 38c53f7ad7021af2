"""Registered Structured Streaming queries (T1-T5, and C7 as a stream) on driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import jobs as J
from ..session import ensure_utc, scratch_path
from ..sources.testdata import table
from ..streaming import streams as S
from ..streaming import watermark as WM
from . import oracle as O
from . import standins
from .jobs_queries import AUDIT_SQL, RUN1_TS, RUN2_TS, key_buckets, scratch_database
from .registry import register


def _events_stream(spark, sf_dir) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return S.file_stream(spark, sf_dir, schema, glob="events.parquet")


@register("stream_jobs_available_now", "WITH" + O.POSTINGS_CTE + "\nSELECT * FROM clean")
def stream_jobs_available_now(spark, sf_dir):
    """T1 + T3: the postings load as a file stream with a checkpoint, run
    with ``availableNow``; a second run finds nothing new and adds 0 rows."""
    ensure_utc(spark)
    sink, ckpt = scratch_path(spark, "stream_jobs"), scratch_path(spark, "stream_jobs_ckpt")
    clean = J.clean_postings(J.flatten_postings(standins.postings(_events_stream(spark, sf_dir))))
    S.run_available_now(clean, ckpt, sink_path=sink)
    again = S.run_available_now(clean, ckpt, sink_path=sink)
    if again:
        raise AssertionError(f"second availableNow run re-read {again} rows")
    return spark.read.parquet(sink)


def _land_slices(spark, sf_dir, landing: str) -> list[DataFrame]:
    """Slice A and slice B (the overlap re-fetched, edited) as two landings."""
    clean = J.clean_postings(J.flatten_postings(standins.postings(table(spark, sf_dir, "events"))))
    a, b = standins.overlap_slices(clean)
    return [a, b.drop("job_salary")]


@register("stream_jobs_dedup", "WITH" + O.POSTINGS_CTE + """
SELECT * FROM slice_a
UNION ALL
SELECT * EXCLUDE (job_salary) FROM slice_b WHERE job_id NOT IN (SELECT job_id FROM slice_a)""")
def stream_jobs_dedup(spark, sf_dir):
    """Two scheduled runs -- slice A lands, run; slice B (12 h overlap,
    re-fetched rows) lands, run.  Each micro-batch keeps one row per id and
    the stored ids are anti joined: the first arrival is kept, as
    insert-if-new does, however late or far in the future a row is dated."""
    ensure_utc(spark)
    landing = scratch_path(spark, "postings_landing")
    ckpt = scratch_path(spark, "stream_dedup_ckpt")
    name = f"{scratch_database(spark, 'stream_dedup')}.postings"
    slices = _land_slices(spark, sf_dir, landing)
    schema = slices[0].schema
    for s in slices:
        s.write.mode("append").parquet(landing)
        S.run_available_now(S.file_stream(spark, landing, schema), ckpt,
                            foreach_batch=S.append_new_batch(name, "job_id", [], ts="job_created"))
    return spark.table(name)


FUTURE_RUNS = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20), dt.datetime(2024, 2, 15))


@register("stream_jobs_future", "WITH" + O.POSTINGS_CTE + f"""
SELECT *, CAST(CASE WHEN job_created <= TIMESTAMP '{FUTURE_RUNS[0]}' THEN 1
                    WHEN job_created <= TIMESTAMP '{FUTURE_RUNS[1]}' THEN 2 ELSE 3 END AS INTEGER) AS run
FROM clean WHERE job_created <= TIMESTAMP '{FUTURE_RUNS[2]}'""")
def stream_jobs_future(spark, sf_dir):
    """T2 with F1: all postings land before the first of three runs, so most
    are dated after it; then, with nothing new but some late re-fetches, each run takes up what
    its clock has reached.  No row is dropped as too late or too early."""
    ensure_utc(spark)
    landing, ckpt = scratch_path(spark, "future_landing"), scratch_path(spark, "future_ckpt")
    name = f"{scratch_database(spark, 'stream_future')}.postings"
    clean = J.clean_postings(J.flatten_postings(standins.postings(table(spark, sf_dir, "events"))))
    late = clean.where(F.col("job_created") <= F.lit(FUTURE_RUNS[0]).cast("timestamp_ntz"))
    for k, run_ts in enumerate(FUTURE_RUNS, 1):
        (clean if k == 1 else late).write.mode("append").parquet(landing)
        S.run_available_now(
            S.file_stream(spark, landing, clean.schema), ckpt,
            foreach_batch=S.append_new_batch(name, "job_id", [], ts="job_created", run_ts=run_ts,
                                             audit=lambda df, k=k: df.withColumn("run", F.lit(k))))
    return spark.table(name)


HOUR_PARTS = ["year", "month", "day", "hour"]


def _hour_records(events: DataFrame) -> DataFrame:
    """Per (user, hour) weather snapshot with local-time string partitions."""
    from ..functions.scalars import utc_to_local
    from ..config import DEFAULT_LOCAL_TIMEZONE as TZ
    v = standins.hourly_values(events).drop("time")
    local = utc_to_local("hour_utc", TZ)
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    return (v.withColumn("visibility", F.when(F.col("user_id") % 5 == 0, F.lit(None))
                         .otherwise(F.col("visibility")))
             .withColumn("year", F.year(local).cast("string"))
             .withColumn("month", pad(F.month(local))).withColumn("day", pad(F.dayofmonth(local)))
             .withColumn("hour", pad(F.hour(local))))


@register("stream_weather_upsert", "WITH" + O.WEATHER_CTE + """
SELECT user_id AS site_id, hour_utc, temperature_2m, relative_humidity_2m, dew_point_2m,
       apparent_temperature, precipitation, rain, wind_speed_10m, wind_direction_10m,
       wind_gusts_10m, surface_pressure, cloud_cover, visibility,
       CAST(year(hour_utc + INTERVAL 2 HOUR) AS VARCHAR) AS year,
       lpad(CAST(month(hour_utc + INTERVAL 2 HOUR) AS VARCHAR), 2, '0') AS month,
       lpad(CAST(day(hour_utc + INTERVAL 2 HOUR) AS VARCHAR), 2, '0') AS day,
       lpad(CAST(hour(hour_utc + INTERVAL 2 HOUR) AS VARCHAR), 2, '0') AS hour
FROM hourly_vals""")
def stream_weather_upsert(spark, sf_dir):
    """T4: hourly snapshots land with each hour's sites spread over the files,
    so an hour comes in several micro-batches; the stream replaces records by
    (site, hour) (``foreachBatch``).  A full replay from a fresh checkpoint
    writes the same records again: every snapshot is stored once."""
    ensure_utc(spark)
    landing, sink = scratch_path(spark, "hours_landing"), scratch_path(spark, "hours_sink")
    recs = _hour_records(table(spark, sf_dir, "events"))
    recs.repartition(4, "user_id").write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    upsert = S.merge_hours_batch(sink, HOUR_PARTS, ["user_id", "hour_utc"])
    for most in (2, None):  # the run in two batches, then a full replay in one
        ckpt = scratch_path(spark, "hours_ckpt")
        S.run_available_now(S.file_stream(spark, landing, schema, max_files_per_trigger=most),
                            ckpt, foreach_batch=upsert)
    out_schema = T.StructType([f for f in spark.read.parquet(sink).schema.fields if f.name not in HOUR_PARTS]
                              + [T.StructField(c, T.StringType()) for c in HOUR_PARTS])
    return (spark.read.schema(out_schema).parquet(sink)
            .withColumnRenamed("user_id", "site_id"))


@register("stream_state_version", "WITH" + O.POSTINGS_CTE + f""",
sizes AS (SELECT (SELECT count(*) FROM slice_a) AS a, (SELECT count(*) FROM slice_b) AS b,
                 (SELECT max(job_created) FROM slice_a) AS ma, (SELECT max(job_created) FROM slice_b) AS mb)
SELECT 'jobs_stream' AS state_id, CAST(1 AS BIGINT) AS version, ma AS last_extraction_time,
       a AS total_jobs_extracted, TIMESTAMP '{RUN1_TS}' AS created_at, TIMESTAMP '{RUN1_TS}' AS updated_at FROM sizes
UNION ALL
SELECT 'jobs_stream', 2, greatest(ma, mb), a + b, TIMESTAMP '{RUN1_TS}', TIMESTAMP '{RUN2_TS}' FROM sizes""")
def stream_state_version(spark, sf_dir):
    """T5: each micro-batch commits a control-table row (two runs -> versions
    1 and 2) under the claim of its version; a replayed batch is a no-op."""
    ensure_utc(spark)
    landing, ckpt = scratch_path(spark, "state_landing"), scratch_path(spark, "state_ckpt")
    db = scratch_database(spark, "state")
    state_table = f"{db}.pipeline_state"
    slices = _land_slices(spark, sf_dir, landing)
    schema = slices[0].schema
    for s, run_ts in zip(slices, (RUN1_TS, RUN2_TS)):
        s.write.mode("append").parquet(landing)
        commit = S.versioned_state_batch(state_table, "jobs_stream", "job_created", ckpt,
                                         clock=lambda t=run_ts: t)
        S.run_available_now(S.file_stream(spark, landing, schema), ckpt, foreach_batch=commit)
    return spark.table(state_table)


@register("stream_jobs_upsert", "WITH" + O.POSTINGS_CTE + "," + AUDIT_SQL + """
SELECT * FROM stored
UNION ALL BY NAME
SELECT * EXCLUDE (job_salary) FROM batch WHERE job_id NOT IN (SELECT job_id FROM stored)""")
def stream_jobs_upsert(spark, sf_dir):
    """C7 as a stream: two scheduled ``availableNow`` runs (slice A, then
    slice B with the re-fetched overlap); one row per id in a batch,
    insert-if-new against the stored table in ``foreachBatch``.  Equals the
    batch insert-if-new load (``jobs_upsert``)."""
    ensure_utc(spark)
    landing, ckpt = scratch_path(spark, "upsert_landing"), scratch_path(spark, "upsert_ckpt")
    db = scratch_database(spark, "stream_jobs")
    name = f"{db}.postings"
    slices = _land_slices(spark, sf_dir, landing)
    schema = slices[0].schema
    for s, run_ts in zip(slices, (RUN1_TS, RUN2_TS)):
        s.write.mode("append").parquet(landing)
        stream = S.file_stream(spark, landing, schema)
        sink = S.append_new_batch(name, "job_id", ["extraction_date"], ts="job_created",
                                  audit=lambda df, ts=run_ts: J.with_audit(df, ts),
                                  bucket_by=(key_buckets(spark), "job_id"))
        S.run_available_now(stream, ckpt, foreach_batch=sink)
    return spark.table(name)


WEEKS, LAST_WEEK, DELAYED = 7, 4, 40        # days a run fetches, the last of the five runs, every which id comes late


@register("stream_jobs_watermark", "WITH" + O.POSTINGS_CTE + f""",
weeks AS (SELECT *, least(datediff('day', TIMESTAMP '2024-01-01', job_created) // {WEEKS}, {LAST_WEEK}) AS week,
                 CAST(substr(job_id, 2) AS BIGINT) % {DELAYED} = 0 AS delayed FROM clean),
landed AS (SELECT *, CASE WHEN delayed THEN least(week + 2, {LAST_WEEK}) ELSE week END AS run FROM weeks),
marks AS (SELECT r.run, (SELECT date_trunc('milliseconds', max(job_created)) - INTERVAL 12 HOUR FROM landed l
                         WHERE l.run < r.run) AS mark
          FROM (SELECT DISTINCT run FROM landed) r)
SELECT l.* EXCLUDE (week, delayed, run), CASE WHEN l.job_created <= m.mark THEN 'late' ELSE 'stored' END AS outcome
FROM landed l JOIN marks m USING (run)""")
def stream_jobs_watermark(spark, sf_dir):
    """T2 in the state store: five weekly runs, each fetching the last 12 h of
    the week before again (edited); every 40th posting comes two runs late.  What is fetched
    again is dropped by the state store, what lies behind the watermark is in the side
    table: every posting once, with the folder that it is in."""
    ensure_utc(spark)
    landing, ckpt, sink = (scratch_path(spark, f"watermark_{x}") for x in ("landing", "ckpt", "sink"))
    clean = J.clean_postings(J.flatten_postings(standins.postings(table(spark, sf_dir, "events"))))
    day = F.datediff(F.to_date("job_created"), F.lit(dt.date(2024, 1, 1)))
    week = F.least(F.floor(day / WEEKS), F.lit(LAST_WEEK)).cast("int")
    delayed = F.substring("job_id", 2, 20).cast("long") % DELAYED == 0
    weeks = clean.withColumns({"week": week, "run": F.when(delayed, F.least(week + 2, F.lit(LAST_WEEK))).otherwise(week),
                               "delayed": delayed})
    for run in range(LAST_WEEK + 1):
        start = F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(days=WEEKS * run)).cast("timestamp_ntz")
        again = weeks.where(~F.col("delayed") & (F.col("week") == run - 1) & (F.col("job_created") < start)
                            & (F.col("job_created") >= start - F.expr("INTERVAL 12 HOURS")))
        fetched = weeks.where(F.col("run") == run).unionByName(
            again.withColumn("job_title", F.concat("job_title", F.lit(" (updated)"))))
        fetched.select(*clean.columns).write.mode("append").parquet(landing)
        WM.dedup_run(S.file_stream(spark, landing, clean.schema), ckpt, sink, "job_id", "job_created", "12 hours")
    parts = {WM.STORED: WM.stored_rows, WM.LATE: WM.late_rows}
    stored, late = (read(spark, sink, clean.schema).withColumn(WM.OUTCOME, F.lit(name)) for name, read in parts.items())
    return stored.unionByName(late)
