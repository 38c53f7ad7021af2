"""No row is lost without a count: records of other sites, malformed input, keys that meet in one run."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.config import DAILY_WEATHER_PARAMS, HOURLY_WEATHER_PARAMS, JobsConfig, WeatherConfig
from lakestrata.operators import jobs as J
from lakestrata.operators import weather as W
from lakestrata.plans.jobs_job import run_jobs
from lakestrata.plans.weather_job import quarantine_path, run_weather_daily, run_weather_hourly
from lakestrata.session import checkpoint_root, local_fs_path, scratch_path
from lakestrata.sources import tables

SITE = [T.StructField("site", T.StringType())]
RUN = dt.datetime(2024, 2, 20, 10)


def land(base, name, *texts):
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/{name}.json", "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in texts))
    return base


def folder(spark, name):
    return local_fs_path(scratch_path(spark, name))


def daily(site, *times, **extra):
    return {"site": site, "daily": {"time": list(times)} | {p: [1.0] * len(times) for p in DAILY_WEATHER_PARAMS}} | extra


def hourly(site, *times):
    return {"site": site, "hourly": {"time": list(times)} | {p: [float(len(t)) for t in times] for p in HOURLY_WEATHER_PARAMS}}


def load_daily(spark, base, out, **kw):
    return run_weather_daily(spark, base, out, RUN, WeatherConfig(years_back=1), keep=["site"],
                             extra_fields=kw.pop("extra", SITE), multi_line=False, **kw).first()


def test_a_month_landed_site_by_site_keeps_both(spark):
    out = folder(spark, "sites")
    for site in ("A", "B", "A"):
        load_daily(spark, land(folder(spark, "in"), "r", daily(site, "2024-01-01", "2024-01-02")), out)
    rows = spark.read.parquet(out).select("site", "date").collect()
    assert sorted((r.site, r.date.day) for r in rows) == [("A", 1), ("A", 2), ("B", 1), ("B", 2)]


def test_the_report_tells_this_runs_months(spark):
    out = folder(spark, "months")
    load_daily(spark, land(folder(spark, "in"), "r", daily("A", "2024-01-05")), out)
    report = load_daily(spark, land(folder(spark, "in"), "r", daily("A", "2024-02-05")), out)
    assert report.success_months == "2024-02" and "2024-01" in report.failed_months
    assert spark.read.parquet(out).count() == 2


def test_broken_responses_and_undated_days_are_kept_apart(spark):
    out = folder(spark, "broken")
    base = land(folder(spark, "in"), "r", daily("A", "2024-01-05", "no date"), '{"site": "B", "daily": {"time": ["2024')
    report = load_daily(spark, base, out)
    assert (report.quarantined, report.rejected_days) == (1, 1)
    kept = spark.read.json(quarantine_path(out)).groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in kept} == {"malformed": 1, "undated": 1}
    assert spark.read.parquet(out).count() == 1


def test_the_request_names_the_month(spark):
    out = folder(spark, "request")
    extra = [*SITE, T.StructField("y", T.StringType()), T.StructField("m", T.StringType())]
    base = land(folder(spark, "in"), "r", daily("A", "2024-01-31", "2024-02-01", y="2024", m="01"))
    load_daily(spark, base, out, extra=extra, request_year="y", request_month="m")
    assert {(r.year, r.month) for r in spark.read.parquet(out).collect()} == {(2024, 1)}


def test_hours_of_other_sites_stay(spark):
    out = folder(spark, "hours")
    run = lambda *r: run_weather_hourly(
        spark, land(folder(spark, "in"), "r", *r), out, dt.datetime(2024, 1, 15, 11, 30), keep=["site"],
        extra_fields=SITE, multi_line=False)
    run(hourly("A", "2024-01-15T12:00"), hourly("B", "2024-01-15T12:00"))
    second = run(hourly("B", "2024-01-15T13:00"), hourly("A", "2024-01-15T12:00"), '{"site": "C", "hour')
    assert second["records"] == 2 and second["quarantined"] == 1
    schema = T.StructType([T.StructField("site", T.StringType()), T.StructField("hour", T.StringType())])
    rows = spark.read.schema(schema).parquet(out).collect()
    assert sorted((r.site, r.hour) for r in rows) == [("A", "12"), ("B", "12"), ("B", "13")]


@pytest.mark.parametrize("go_on", [False, True])
def test_the_state_waits_for_broken_pages(spark, go_on):
    page = {"results": [{"id": "1", "title": "a", "created": "2024-02-19T00:00:00Z"},
                        {"id": "2", "title": "b", "created": "junk"}]}
    base = land(folder(spark, "pages"), "p", page, json.dumps(page)[:50])
    cfg = JobsConfig(database=f"lost_{os.path.basename(base).replace('-', '_')}", advance_over_quarantined=go_on)
    receipt = run_jobs(spark, cfg, base, RUN, db_location=folder(spark, "db"))
    assert (receipt["jobs_processed"], receipt["quarantined_pages"], receipt["rejected_postings"]) == (1, 1, 1)
    assert receipt["state_advanced"] == go_on and receipt["version"] == int(go_on)
    assert spark.table(f"{cfg.database}.{cfg.quarantine_table}").first().record.startswith('{"results"')


def test_merge_takes_the_latest_of_a_key_and_null_keys_match(spark):
    out = folder(spark, "merge")
    frame = lambda *rows: spark.createDataFrame(list(rows), "p string, k string, v int, z string")
    tables.merge_partitions(frame(("1", "a", 1, "x"), ("1", None, 1, "x"), ("2", "a", 1, "x")), out, ["p"], ["k"], ["v"])
    tables.merge_partitions(frame(("1", "a", 3, "y"), ("1", "a", 2, "z"), ("1", None, 4, "y")), out, ["p"], ["k"], ["v"])
    rows = spark.read.schema("p string, k string, v int").parquet(out).collect()
    assert sorted((r.p, r.k or "", r.v) for r in rows) == [("1", "", 4), ("1", "a", 3), ("2", "a", 1)]


def test_profile_of_an_empty_series(spark):
    df = spark.createDataFrame([({"time": []},), ({"time": ["a", "b"]},), (None,)], "hourly struct<time:array<string>>")
    rows = W.response_profile(df).collect()
    assert [(r.first_time, r.last_time) for r in rows] == [(None, None), ("a", "b"), (None, None)]


def test_a_phrase_does_not_span_two_columns(spark):
    df = spark.createDataFrame([("senior data", "engineer wanted"), ("x", "Data Engineer"), ("data engineer", None)], "a string, b string")
    for whole in (False, True):
        assert J.phrase_filter(df, "data engineer", ["a", "b"], whole).count() == 2


@pytest.mark.parametrize("mode", ["time", "range"])
def test_as_of_ties_and_null_keys(spark, mode):
    t = lambda h, d=1: dt.datetime(2024, 1, d, h)
    events = spark.createDataFrame([("a", t(1), "p"), ("a", t(1), "r"), ("a", t(1), "q"), (None, t(1), "n"), ("a", None, "z")],
                                   "k string, ts timestamp_ntz, v string")
    anchors = spark.createDataFrame([("a", t(1)), ("a", t(5, 3)), (None, t(2)), ("a", None)], "k string, at timestamp_ntz")
    got = W.asof_backward(anchors, events, ["k"], "at", "ts", partitioning=mode).select("k", "at", "v").collect()
    assert sorted(map(tuple, got)) == [("a", t(1), "r"), ("a", t(5, 3), "r")]


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://x:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_postings_of_one_page_are_counted_once(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("job_id"), F.lit(1).alias("d"))
    db = f"once_{os.path.basename(scratch_path(spark, 'x')).replace('-', '_')}"
    tables.ensure_database(spark, db, folder(spark, "db"))
    receipt = tables.append_new(df.unionAll(df), f"{db}.t", "job_id", partition_by=["d"])
    assert receipt.new_jobs == 10 and spark.table(f"{db}.t").count() == 10
