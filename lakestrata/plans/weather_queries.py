"""Registered queries of the weather flow on the ``events`` / ``orders`` stand-ins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DAILY_WEATHER_PARAMS, HOURLY_WEATHER_PARAMS
from ..operators import weather as W
from ..session import ensure_utc, scratch_path
from ..sources import raw_json, tables
from ..schemas import DAILY_RECORD
from ..sources.testdata import table
from . import oracle as O
from . import standins
from .registry import register

DAILY_RUN_TS = dt.datetime.fromisoformat(standins.WEATHER_RUN_TS)
HOURLY_RUN_TS = dt.datetime.fromisoformat(standins.HOURLY_RUN_TS)
CALENDAR_RUN_TS = dt.datetime(2001, 6, 15, 9, 30)
REPORT_RUN_TS = dt.datetime(2002, 3, 15, 9, 30)

DAILY_FLAT_COLS = ", ".join(["site_id", "date", *DAILY_WEATHER_PARAMS, "location_name", "latitude",
                             "longitude", "data_source", "api_version", "collected_at", "year", "month"])
HOURLY_FLAT_COLS = ", ".join(["site_id", "timestamp", "date", "hour", *HOURLY_WEATHER_PARAMS,
                              "location_name", "data_source", "api_version", "collected_at",
                              "local_timezone", "year", "month", "day"])


def flat_daily(rows: DataFrame) -> DataFrame:
    """Nested daily records -> top-level columns (for comparison only)."""
    return rows.select(F.col("user_id").alias("site_id"), "date", "weather.*",
                       F.col("location.name").alias("location_name"), "location.latitude",
                       "location.longitude", "metadata.*", "year", "month")


def flat_hourly(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("user_id").alias("site_id"), "timestamp", "date", "hour", "weather.*",
                       F.col("location.name").alias("location_name"), "metadata.*",
                       "year", "month", "day")


def landed_daily_responses(spark, sf_dir) -> DataFrame:
    """S3: daily responses landed as JSON (one response per line) and read
    back with the response schema; the site id rides along."""
    landing = scratch_path(spark, "daily_responses")
    standins.daily_responses(table(spark, sf_dir, "events")).write.json(landing)
    schema = T.StructType(raw_json.DAILY_RESPONSE.fields + [
        T.StructField("user_id", T.LongType()), T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType())])
    return raw_json.read_raw_json(spark, landing, schema, multi_line=False)


def daily_rows(spark, sf_dir) -> DataFrame:
    ensure_utc(spark)
    return W.weather_daily(landed_daily_responses(spark, sf_dir), DAILY_RUN_TS, keep=["user_id"],
                           request_year="year", request_month="month")


def landed_hourly_responses(spark, sf_dir) -> DataFrame:
    """Hourly responses landed as JSON and read back with the response
    schema (zone-less local hour labels, as the forecast API sends them)."""
    landing = scratch_path(spark, "hourly_responses")
    standins.hourly_responses(table(spark, sf_dir, "events")).write.json(landing)
    schema = T.StructType(raw_json.HOURLY_RESPONSE.fields + [T.StructField("user_id", T.LongType())])
    return raw_json.read_raw_json(spark, landing, schema, multi_line=False)


def hour_picks(spark, sf_dir) -> DataFrame:
    ensure_utc(spark)
    return W.nearest_hour(landed_hourly_responses(spark, sf_dir), HOURLY_RUN_TS, keep=["user_id"])


@register("weather_daily_rows", "WITH" + O.WEATHER_CTE + f"\nSELECT {DAILY_FLAT_COLS} FROM daily_rows")
def weather_daily_rows(spark, sf_dir):
    return flat_daily(daily_rows(spark, sf_dir))


@register("arrays_zip_roundtrip", """
SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_events,
       max(value) AS v_max, min(value) AS v_min
FROM events GROUP BY 1, 2""")
def arrays_zip_roundtrip(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    vals = (ev.groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))
            .agg(F.count(F.lit(1)).alias("n_events"), F.max("value").alias("v_max"),
                 F.min("value").alias("v_min")))
    z = W.zip_series(vals, ["day"], "hour", ["n_events", "v_max", "v_min"])
    back = W.unzip_series(z, "series", ["n_events", "v_max", "v_min"], keep=["day"])
    return back.select("day", F.col("time").alias("hour"), "n_events", "v_max", "v_min")


@register("weather_daily_partitions", "WITH" + O.WEATHER_CTE + f"\nSELECT {DAILY_FLAT_COLS} FROM daily_rows")
def weather_daily_partitions(spark, sf_dir):
    """Daily records written with dynamic partition overwrite
    by (year, month), written twice (a re-run replaces its months), read
    back through partition discovery."""
    path = scratch_path(spark, "weather_daily")
    rows = daily_rows(spark, sf_dir)
    for _ in range(2):
        tables.overwrite_partitions(rows, path, ["year", "month"])
    return flat_daily(spark.read.parquet(path))


@register("weather_nearest_hour", "WITH" + O.WEATHER_CTE + f"\nSELECT {HOURLY_FLAT_COLS} FROM hour_rows")
def weather_nearest_hour(spark, sf_dir):
    return flat_hourly(hour_picks(spark, sf_dir))


@register("weather_hour_partitions", "WITH" + O.WEATHER_CTE + """
SELECT site_id, timestamp, date, temperature_2m, relative_humidity_2m, dew_point_2m,
       apparent_temperature, precipitation, rain, wind_speed_10m, wind_direction_10m,
       wind_gusts_10m, surface_pressure, cloud_cover, visibility,
       CAST(year AS VARCHAR) AS year, lpad(CAST(month AS VARCHAR), 2, '0') AS month,
       lpad(CAST(day AS VARCHAR), 2, '0') AS day, lpad(CAST(hour AS VARCHAR), 2, '0') AS hour
FROM hour_rows""")
def weather_hour_partitions(spark, sf_dir):
    """Hour picks under zero-padded ``year/month/day/hour`` string
    partitions, dynamic overwrite (the same hour is replaced), read back
    with a schema that keeps the partitions as strings."""
    path = scratch_path(spark, "weather_hourly")
    picks = W.hour_partition_columns(hour_picks(spark, sf_dir))
    for _ in range(2):
        tables.overwrite_partitions(picks, path, ["year", "month", "day", "hour"])
    stored_schema = spark.read.parquet(path).schema
    schema = T.StructType([f for f in stored_schema.fields if f.name not in ("year", "month", "day", "hour")]
                          + [T.StructField(c, T.StringType()) for c in ("year", "month", "day", "hour")])
    back = spark.read.schema(schema).parquet(path)
    return back.select(F.col("user_id").alias("site_id"), "timestamp", "date", "weather.*",
                       "year", "month", "day", "hour")


ASOF_SQL = """
WITH anchors AS (
  SELECT DISTINCT user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR AS anchor_ts FROM events)
SELECT a.user_id, a.anchor_ts, e.ts, e.event_id, e.value
FROM anchors a ASOF JOIN events e ON a.user_id = e.user_id AND e.ts <= a.anchor_ts"""


@register("asof_backward", ASOF_SQL)
def asof_backward(spark, sf_dir):
    """J2, many anchors: one anchor per (user, day) at 12:00; time buckets."""
    return _asof(spark, sf_dir, "time")


@register("asof_backward_range", ASOF_SQL)
def asof_backward_range(spark, sf_dir):
    """The same as-of join with range-partitioned buckets (keys dense in
    time are split by sampled boundaries)."""
    return _asof(spark, sf_dir, "range")


NEAREST_SQL = """
WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events),
anchors AS (SELECT user_id, CAST(d AS TIMESTAMP) + INTERVAL 12 HOUR AS anchor_ts FROM days
            UNION ALL SELECT user_id, CAST(d AS TIMESTAMP) - INTERVAL 60 DAY FROM days WHERE day(d) % 2 = 0),
back AS (SELECT a.user_id, a.anchor_ts, e.ts, e.event_id, e.value
         FROM anchors a ASOF JOIN events e ON a.user_id = e.user_id AND e.ts <= a.anchor_ts),
ahead AS (SELECT a.user_id, a.anchor_ts, e.ts, e.event_id, e.value
          FROM anchors a ASOF JOIN events e ON a.user_id = e.user_id AND e.ts >= a.anchor_ts)
SELECT * FROM back UNION ALL SELECT * FROM ahead ANTI JOIN back USING (user_id, anchor_ts)"""


def _nearest(spark, sf_dir, partitioning):
    ev = table(spark, sf_dir, "events")
    days = ev.select("user_id", F.to_date("ts").alias("d")).distinct()
    noon = days.select("user_id", (F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")).alias("anchor_ts"))
    before = days.where(F.dayofmonth("d") % 2 == 0).select(
        "user_id", (F.col("d").cast("timestamp_ntz") - F.expr("INTERVAL 60 DAYS")).alias("anchor_ts"))
    return W.asof_backward(noon.unionByName(before), ev.select("user_id", "ts", "event_id", "value"),
                           ["user_id"], "anchor_ts", "ts", partitioning=partitioning, forward=True)


@register("asof_nearest", NEAREST_SQL)
def asof_nearest(spark, sf_dir):
    """J2 for many anchors with its fallback: about a third of the anchors lie weeks before
    their key's first event and get that event; all others the latest one before them."""
    return _nearest(spark, sf_dir, "time")


@register("asof_nearest_range", NEAREST_SQL)
def asof_nearest_range(spark, sf_dir):
    """The same with range-partitioned buckets."""
    return _nearest(spark, sf_dir, "range")


def _asof(spark, sf_dir, partitioning):
    ev = table(spark, sf_dir, "events")
    anchors = ev.select("user_id", (F.to_date("ts").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS"))
                        .alias("anchor_ts")).distinct()
    return W.asof_backward(anchors, ev.select("user_id", "ts", "event_id", "value"),
                           ["user_id"], "anchor_ts", "ts", partitioning=partitioning)


@register("response_profile", "WITH" + O.WEATHER_CTE + """
SELECT user_id AS site_id, CAST(count(*) AS INTEGER) AS n_points,
       min(strftime(hour_utc + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M')) AS first_time,
       max(strftime(hour_utc + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M')) AS last_time
FROM hourly_vals GROUP BY user_id""")
def response_profile(spark, sf_dir):
    resp = standins.hourly_responses(table(spark, sf_dir, "events"))
    return W.response_profile(resp, keep=[F.col("user_id").alias("site_id")])


@register("month_calendar", f"""
WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
m AS (SELECT CAST(unnest(generate_series(date_trunc('month', s), date_trunc('month', e),
                                          INTERVAL 1 MONTH)) AS DATE) AS month_start FROM b)
SELECT month_start, least(last_day(month_start), DATE '{CALENDAR_RUN_TS.date()}') AS month_end,
       strftime(month_start, '%Y-%m') AS month_label,
       CAST(year(month_start) AS INTEGER) AS year, CAST(month(month_start) AS INTEGER) AS month
FROM m WHERE month_start <= DATE '{CALENDAR_RUN_TS.date()}'""")
def month_calendar(spark, sf_dir):
    bounds = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("s"),
                                                F.max("o_orderdate").alias("e"))
    return W.month_calendar(bounds, "s", "e", CALENDAR_RUN_TS)


@register("month_load_report", f"""
WITH m AS (SELECT CAST(unnest(generate_series(DATE '{REPORT_RUN_TS.year - 3}-{REPORT_RUN_TS.month:02d}-01',
                                               DATE '{REPORT_RUN_TS.date()}', INTERVAL 1 MONTH)) AS DATE) AS month_start),
loaded AS (SELECT DISTINCT year(o_orderdate) AS y, month(o_orderdate) AS mo FROM orders),
j AS (SELECT strftime(month_start, '%Y-%m') AS label, l.y IS NOT NULL AS ok
      FROM m LEFT JOIN loaded l ON l.y = year(month_start) AND l.mo = month(month_start))
SELECT coalesce(array_to_string(list_sort(list(label) FILTER (WHERE ok)), ','), '') AS success_months,
       coalesce(array_to_string(list_sort(list(label) FILTER (WHERE NOT ok)), ','), '') AS failed_months,
       count(*) AS total_months_processed
FROM j""")
def month_load_report(spark, sf_dir):
    """Calendar of the last 3 years (37 months) against the months that
    actually hold orders."""
    cal = W.calendar_back(spark, REPORT_RUN_TS, 3)
    loaded = (table(spark, sf_dir, "orders")
              .groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
              .agg(F.count(F.lit(1)).alias("rows")))
    return W.month_load_report(cal, loaded)


@register("partition_pruned_scan", """
SELECT event_id, ts, user_id, event_type, value, 2024 AS year, 1 AS month,
       CAST(day(ts) AS INTEGER) AS day
FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'""")
def partition_pruned_scan(spark, sf_dir):
    """Events landed as a JSON ``year=/month=/day=`` tree; the read
    names the schema (partition columns as int), filters on partition
    columns (directory pruning) and reads only the needed fields."""
    base = scratch_path(spark, "events_tree")
    ev = table(spark, sf_dir, "events")
    raw_json.write_json(ev.withColumn("year", F.year("ts")).withColumn("month", F.month("ts"))
                        .withColumn("day", F.dayofmonth("ts")), base, ["year", "month", "day"])
    schema = T.StructType([f for f in ev.schema.fields] + [
        T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType())])
    tree = raw_json.read_partitioned_tree(spark, base, schema, multi_line=False)
    return (tree.where((F.col("year") == 2024) & (F.col("month") == 1) & F.col("day").between(10, 12))
            .select("event_id", "ts", "user_id", "event_type", "value", "year", "month", "day"))


DAILY_JOB_RUN_TS = dt.datetime(2024, 1, 20, 10)


@register("weather_daily_job", "WITH" + O.WEATHER_CTE + f"""
SELECT * REPLACE (TIMESTAMP '{DAILY_JOB_RUN_TS}' AS collected_at)
FROM (SELECT {DAILY_FLAT_COLS} FROM daily_rows)
WHERE date <= DATE '{DAILY_JOB_RUN_TS.date()}'""")
def weather_daily_job(spark, sf_dir):
    """C10 end to end: landed responses -> calendar of the last year ->
    days up to the run date -> dynamic overwrite by (year, month); the
    stored records are returned (the load report is checked in the tests)."""
    from ..config import WeatherConfig
    from .weather_job import run_weather_daily
    landing = scratch_path(spark, "daily_job_responses")
    standins.daily_responses(table(spark, sf_dir, "events")).drop("year", "month").write.json(landing)
    out = scratch_path(spark, "daily_job_out")
    run_weather_daily(spark, landing, out, DAILY_JOB_RUN_TS, WeatherConfig(years_back=1),
                      keep=["user_id"], extra_fields=[T.StructField("user_id", T.LongType())],
                      multi_line=False)
    return flat_daily(spark.read.parquet(out))


@register("weather_hourly_job", "WITH" + O.WEATHER_CTE + """
SELECT site_id, timestamp, date, temperature_2m, relative_humidity_2m, dew_point_2m,
       apparent_temperature, precipitation, rain, wind_speed_10m, wind_direction_10m,
       wind_gusts_10m, surface_pressure, cloud_cover, visibility, location_name,
       data_source, api_version, collected_at, local_timezone,
       CAST(year AS VARCHAR) AS year, lpad(CAST(month AS VARCHAR), 2, '0') AS month,
       lpad(CAST(day AS VARCHAR), 2, '0') AS day, lpad(CAST(hour AS VARCHAR), 2, '0') AS hour
FROM hour_rows""")
def weather_hourly_job(spark, sf_dir):
    """C12 end to end: landed hourly responses -> nearest-hour pick per
    response -> the hour's partitions replaced (run twice: the same hour is
    rewritten, not duplicated); the stored records are returned with their
    string partitions."""
    from ..config import WeatherConfig
    from .weather_job import run_weather_hourly
    landing = scratch_path(spark, "hourly_job_responses")
    standins.hourly_responses(table(spark, sf_dir, "events")).write.json(landing)
    out = scratch_path(spark, "hourly_job_out")
    for _ in range(2):
        run_weather_hourly(spark, landing, out, HOURLY_RUN_TS, WeatherConfig(), keep=["user_id"],
                           extra_fields=[T.StructField("user_id", T.LongType())], multi_line=False)
    parts = ("year", "month", "day", "hour")
    stored = spark.read.parquet(out).schema
    schema = T.StructType([f for f in stored.fields if f.name not in parts]
                          + [T.StructField(c, T.StringType()) for c in parts])
    back = spark.read.schema(schema).parquet(out)
    return back.select(F.col("user_id").alias("site_id"), "timestamp", "date", "weather.*",
                       F.col("location.name").alias("location_name"), "metadata.*",
                       *parts)


@register("weather_sites_daily", "WITH" + O.WEATHER_CTE + f"""
SELECT * REPLACE (TIMESTAMP '{DAILY_JOB_RUN_TS}' AS collected_at)
FROM (SELECT {DAILY_FLAT_COLS} FROM daily_rows)
WHERE date <= DATE '{DAILY_JOB_RUN_TS.date()}'""")
def weather_sites_daily(spark, sf_dir):
    """C9, K2 keyed by site: the sites' months land site group by site group,
    in three runs (the last a replay) that share the month partitions, with
    the request's year and month carried (P11); read back as the month tree
    (S6).  No run removes another site's rows."""
    from ..config import WeatherConfig
    from .weather_job import run_weather_daily
    out = scratch_path(spark, "sites_out")
    responses = standins.daily_responses(table(spark, sf_dir, "events")).withColumnsRenamed(
        {"year": "request_year", "month": "request_month"})
    fields = [T.StructField("user_id", T.LongType()), T.StructField("request_year", T.IntegerType()),
              T.StructField("request_month", T.IntegerType())]
    for rest in (0, 1, 0):
        landing = scratch_path(spark, "sites_responses")
        responses.where(F.col("user_id") % 2 == rest).write.json(landing)
        run_weather_daily(spark, landing, out, DAILY_JOB_RUN_TS, WeatherConfig(years_back=1), keep=["user_id"],
                          extra_fields=fields, multi_line=False, request_year="request_year",
                          request_month="request_month")
    schema = T.StructType([T.StructField("user_id", T.LongType()), *DAILY_RECORD.fields])
    return flat_daily(raw_json.read_partitioned_tree(spark, out, schema, fmt="parquet"))


# two runs over the months of the orders: what lands for a month goes by its number
OUTCOME_RUNS = (dt.datetime(2001, 6, 15, 9, 30), dt.datetime(2001, 9, 20, 9, 30))
OUTCOME_YEARS = 3


@register("weather_month_outcomes", f"""
WITH days AS (SELECT DISTINCT o_custkey % 4 AS site, CAST(o_orderdate AS DATE) AS day,
                     year(o_orderdate) AS y, month(o_orderdate) AS mo FROM orders),
runs AS (SELECT * FROM (VALUES (1, TIMESTAMP '{OUTCOME_RUNS[0]}'), (2, TIMESTAMP '{OUTCOME_RUNS[1]}')) t(run, run_ts)),
responses AS (
  SELECT r.run, r.run_ts, site, y, mo, count(*) AS n, count(*) FILTER (WHERE day <= CAST(run_ts AS DATE)) AS past,
         CASE WHEN run = 2 AND mo % 6 IN (1, 2) THEN 'days' WHEN mo % 6 = 1 THEN 'none' WHEN mo % 6 = 2 THEN 'broken'
              WHEN mo % 6 = 3 THEN 'undated' WHEN mo % 6 = 4 THEN 'bare' ELSE 'days' END AS kind
  FROM days JOIN runs r ON site // 2 = r.run - 1 GROUP BY ALL),
arrived AS (
  SELECT run, y, mo, count(*) FILTER (WHERE kind <> 'broken') AS ok, count(*) FILTER (WHERE kind = 'broken') AS broken,
         coalesce(sum(past) FILTER (WHERE kind = 'days'), 0) AS past, coalesce(sum(n) FILTER (WHERE kind = 'undated'), 0) AS undated
  FROM responses WHERE kind <> 'none' GROUP BY ALL),
asked AS (SELECT run, year(m) AS y, month(m) AS mo FROM (
  SELECT run, unnest(generate_series(date_trunc('month', run_ts) - INTERVAL {OUTCOME_YEARS} YEAR, date_trunc('month', run_ts),
                                     INTERVAL 1 MONTH)) AS m FROM runs)),
ledger AS (
  SELECT run, y, mo, coalesce(past, 0) AS past, coalesce(broken, 0) AS broken, coalesce(undated, 0) AS undated,
         CASE WHEN a.run IS NULL THEN 'outside' WHEN past > 0 THEN 'loaded' WHEN broken + undated > 0 THEN 'quarantined'
              WHEN ok > 0 THEN 'empty' ELSE 'missing' END AS outcome
  FROM (SELECT *, run AS r FROM arrived) FULL JOIN (SELECT *, run AS r FROM asked) a USING (run, y, mo)),
history AS (
  SELECT y, mo, count(*) AS runs, count(*) FILTER (WHERE outcome = 'loaded') AS loaded_runs, arg_max(outcome, run) AS last_outcome,
         max(run) AS last, coalesce(arg_max(past, run) FILTER (WHERE outcome = 'loaded'), 0) AS days_loaded,
         sum(broken) AS malformed, sum(undated) AS days_undated FROM ledger GROUP BY ALL)
SELECT CAST(y AS INTEGER) AS year, CAST(mo AS INTEGER) AS month, h.runs, loaded_runs, last_outcome, run_ts AS last_run,
       CAST(days_loaded AS BIGINT) AS days_loaded, CAST(malformed AS BIGINT) AS malformed,
       CAST(days_undated AS BIGINT) AS days_undated, CASE WHEN loaded_runs > 0 THEN 'loaded' ELSE last_outcome END AS state
FROM history h JOIN runs r ON r.run = h.last""")
def weather_month_outcomes(spark, sf_dir):
    """A8 / C9 over two daily runs that write the ledger of months: in the first some months
    are missing, malformed (their text still names the month), undated or without days, or lie outside the
    calendar; the second brings other sites and mends two kinds of them."""
    from ..config import WeatherConfig
    from .jobs_queries import scratch_database
    from .weather_job import run_weather_daily
    out, ledger = scratch_path(spark, "outcomes_out"), f"{scratch_database(spark, 'outcomes')}.months"
    days = table(spark, sf_dir, "orders").groupBy(
        (F.col("o_custkey") % 4).alias("site_id"), F.to_date("o_orderdate").alias("day")).agg(
        F.max("o_totalprice").alias("temperature_2m_max")).withColumns(
        {"y": F.year("day"), "mo": F.month("day"), "text": F.col("day").cast("string")})
    kind = F.col("mo") % 6
    for run, run_ts in enumerate(OUTCOME_RUNS):
        landing = scratch_path(spark, "outcomes_responses")
        mended = F.lit(run == 1) & kind.isin(1, 2)
        sites = days.where((F.floor(F.col("site_id") / 2) == run) & (mended | (kind != 1)))
        sites = sites.withColumn("text", F.when(kind == 3, "n/a").otherwise(F.col("text")))
        responses = W.zip_series(sites, ["site_id", "y", "mo"], "text", ["temperature_2m_max"], out="daily")
        whole = F.to_json(F.struct("y", "mo", "site_id", "daily"))
        bare = F.to_json(F.struct("y", "mo", "site_id"))
        cut = F.substring_index(whole, "\"temperature", 1)
        text = F.when(mended, whole).when(kind == 2, cut).when(kind == 4, bare).otherwise(whole)
        responses.select(text.alias("value")).write.text(landing)
        fields = [T.StructField("site_id", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("mo", T.IntegerType())]
        run_weather_daily(spark, landing, out, run_ts, WeatherConfig(years_back=OUTCOME_YEARS), keep=["site_id"],
                          extra_fields=fields, multi_line=False, request_year="y", request_month="mo", ledger=ledger)
    return W.month_history(spark.table(ledger))
