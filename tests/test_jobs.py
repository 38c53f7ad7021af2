"""Incremental postings load on hand-written pages (FIXTURES §2, §3)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lakestrata.config import JobsConfig
from lakestrata.functions.scalars import ts_lit
from lakestrata.operators import jobs as J
from lakestrata.operators import state as ST
from lakestrata.plans.jobs_job import run_jobs
from lakestrata.session import local_fs_path, scratch_path
from lakestrata.sources import raw_json

RUN1 = dt.datetime(2024, 3, 10, 12)      # first run: default state -> 7 days back
START1 = RUN1 - dt.timedelta(days=7, hours=12)   # minus the 12 h overlap
RUN2 = dt.datetime(2024, 3, 11, 12)
START2 = RUN1 - dt.timedelta(hours=12)


def posting(i, created, **kw):
    p = {"id": f"P{i}", "title": f"Data Engineer {i}", "description": "build pipelines",
         "redirect_url": f"https://jobs.example/{i}", "created": created,
         "location": {"display_name": "Toronto"}, "company": {"display_name": "Acme"},
         "category": {"label": "IT Jobs"}}
    p.update(kw)
    return {k: v for k, v in p.items() if v is not ...}


def iso(t: dt.datetime) -> str:
    return t.strftime("%Y-%m-%dT%H:%M:%SZ")


def run1_pages():
    full = [posting(i, iso(RUN1 - dt.timedelta(hours=i))) for i in range(50)]
    full[0] = posting(0, iso(RUN1 - dt.timedelta(hours=2)))                      # re-posted below
    full[1] = posting(1, iso(RUN1 - dt.timedelta(hours=1)), location=...)        # missing parent
    full[2] = posting(2, iso(RUN1 - dt.timedelta(hours=2)), location=None)       # explicit null
    full[3] = posting(3, iso(RUN1), id=None)                                     # null id
    full[4] = posting(4, iso(RUN1), title=None)                                  # null title
    full[5] = posting(5, None)                                                   # null created
    full[6] = posting(6, "2024-03-09T10:00:00+02:00")                            # offset
    full[7] = posting(7, "yesterday")                                            # junk
    full[8] = posting(8, iso(START1))                                            # on the lower bound
    full[9] = posting(9, iso(START1 - dt.timedelta(seconds=1)))                  # one second out
    full[10] = posting(10, iso(RUN1))                                            # on the upper bound
    full[11] = posting(11, iso(RUN1 + dt.timedelta(seconds=1)))                  # one second out
    short = [posting(12, iso(RUN1 - dt.timedelta(hours=3))),
             posting(0, iso(RUN1 - dt.timedelta(minutes=30)), title="Data Engineer 0 (edited)")]
    return [{"results": full}, {"results": short}, {"results": []}]


def run2_pages():
    return [{"results": [posting(100, iso(RUN2 - dt.timedelta(hours=1))),
                         posting(12, iso(RUN1 - dt.timedelta(hours=3))),     # stored in run 1
                         posting(101, iso(START2 - dt.timedelta(hours=1)))]}]  # before the window


def land(base, name, pages):
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/{name}.json", "w") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")


@pytest.fixture(scope="module")
def runs(spark):
    root = scratch_path(spark, "jobs_fixture")
    base = local_fs_path(root)
    cfg = JobsConfig(database=f"jobs_{os.path.basename(base).replace('-', '_')}")
    land(f"{base}/run1", "pages", run1_pages())
    r1 = run_jobs(spark, cfg, f"{base}/run1", RUN1, db_location=f"{base}/db")
    land(f"{base}/run2", "pages", run2_pages())
    r2 = run_jobs(spark, cfg, f"{base}/run2", RUN2, db_location=f"{base}/db")
    r3 = run_jobs(spark, cfg, f"{base}/run2", RUN2 + dt.timedelta(hours=1), db_location=f"{base}/db")
    return cfg, base, r1, r2, r3


def test_flatten_is_null_safe(spark, runs):
    _, base, *_ = runs
    flat = J.flatten_postings(J.explode_pages(raw_json.read_job_pages(spark, f"{base}/run1")))
    rows = {r["job_id"]: r for r in flat.collect()}
    assert len(flat.collect()) == 52           # empty page gives no rows
    assert rows["P1"]["job_location"] is None and rows["P2"]["job_location"] is None
    assert rows["P0"]["job_company"] == "Acme" and rows["P0"]["job_category"] == "IT Jobs"


def test_clean_parses_and_drops(spark, runs):
    _, base, *_ = runs
    flat = J.flatten_postings(J.explode_pages(raw_json.read_job_pages(spark, f"{base}/run1")))
    clean = {r["job_id"]: r for r in J.clean_postings(flat).collect()}
    assert None not in clean and "P4" not in clean and "P5" not in clean and "P7" not in clean
    assert clean["P6"]["job_created"] == dt.datetime(2024, 3, 9, 8, 0)   # offset -> UTC


def test_first_run_window_and_dedup(spark, runs):
    cfg, _, r1, *_ = runs
    assert r1["extraction_window_start"] == START1 and r1["extraction_window_end"] == RUN1
    stored = {r["job_id"]: r for r in spark.table(f"{cfg.database}.{cfg.table}").collect()}
    assert "P8" in stored and "P10" in stored            # both bounds inclusive
    assert "P9" not in stored and "P11" not in stored    # one second outside
    assert stored["P0"]["job_title"].endswith("(edited)")  # same id twice: latest created wins
    first = [r for r in stored.values() if r["extraction_date"] == RUN1.date()]
    assert r1["jobs_processed"] == len(first) and r1["version"] == 1
    assert r1["files_written"] >= 1


def test_second_run_inserts_only_new(spark, runs):
    cfg, _, r1, r2, r3 = runs
    assert r2["extraction_window_start"] == START2
    assert r2["jobs_processed"] == 1                     # P100; P12 stored, P101 too old
    assert r3["jobs_processed"] == 0 and not r3["table_updated"]
    t = spark.table(f"{cfg.database}.{cfg.table}")
    assert t.count() == t.select("job_id").distinct().count()
    assert {r["extraction_date"] for r in t.collect()} == {RUN1.date(), RUN2.date()}


def test_state_versions(spark, runs):
    cfg, *_ , r3 = runs
    state = spark.table(f"{cfg.database}.{cfg.state_table}")
    assert sorted(r["version"] for r in state.collect()) == [1, 2, 3]
    cur = ST.current_state(state).first()
    assert cur["version"] == 3 and cur["last_extraction_time"] == RUN2 + dt.timedelta(hours=1)
    first = state.where(F.col("version") == 1).first()
    assert cur["created_at"] == first["created_at"] == RUN1       # created_at survives
    with pytest.raises(ST.VersionConflict):
        ST.commit_state(spark, f"{cfg.database}.{cfg.state_table}", cfg.state_id, 2, RUN2, 0)


def test_default_state(spark):
    empty = spark.createDataFrame([], ST.PIPELINE_STATE)
    req = spark.createDataFrame([("new_pipeline",)], "state_id string")
    row = ST.with_defaults(req, empty, RUN1, 7).first()
    assert row["version"] == 0 and row["total_jobs_extracted"] == 0 and row["is_default"]
    assert row["last_extraction_time"] == RUN1 - dt.timedelta(days=7)


def test_max_age_and_phrase(spark):
    df = spark.createDataFrame(
        [("a", "Senior Data Engineer", dt.datetime(2024, 3, 1)),
         ("b", "Big-data engineering", dt.datetime(2024, 3, 9)),
         ("c", "data engineers wanted", dt.datetime(2024, 3, 9))],
        "job_id string, job_title string, job_created timestamp_ntz")
    assert J.max_age_days(RUN1, RUN1 - dt.timedelta(days=45), 30) == 30
    assert J.max_age_days(RUN1, RUN1 - dt.timedelta(days=45)) == 46
    kept = J.within_max_age(df, RUN1, RUN1 - dt.timedelta(days=3))
    assert {r["job_id"] for r in kept.collect()} == {"b", "c"}
    sub = J.phrase_filter(df, "data engineer", ["job_title"])
    whole = J.phrase_filter(df, "data engineer", ["job_title"], whole_words=True)
    assert {r["job_id"] for r in sub.collect()} == {"a", "b", "c"}   # substring
    assert {r["job_id"] for r in whole.collect()} == {"a"}


def test_overlap_zero_vs_twelve_hours_same_keys(spark):
    rows = [(f"J{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(100)]
    df = spark.createDataFrame(rows, "job_id string, job_created timestamp_ntz")
    cut = dt.datetime(2024, 1, 3)
    keys = []
    for overlap in (0, 12):
        a = df.where(F.col("job_created") < ts_lit(cut))
        b = df.where(F.col("job_created") >= ts_lit(cut - dt.timedelta(hours=overlap)))
        keys.append(sorted(r[0] for r in J.dedup_postings(J.union_pages(a, b)).collect()))
    assert keys[0] == keys[1] and len(keys[0]) == 100


def test_bucketed_table_gives_same_rows(spark, runs):
    cfg, base, *_ = runs
    bcfg = JobsConfig(database=cfg.database + "_b", key_buckets=4)
    for path, ts in ((f"{base}/run1", RUN1), (f"{base}/run2", RUN2)):
        run_jobs(spark, bcfg, path, ts, db_location=f"{base}/dbb")
    rows = lambda c: sorted(tuple(r) for r in spark.table(f"{c.database}.{c.table}")
                            .select(*J.FLAT, "extraction_date").collect())
    assert rows(bcfg) == rows(cfg)
