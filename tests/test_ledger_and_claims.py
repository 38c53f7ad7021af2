"""Landed files are read once, held rows come out in time, dead claims don't block, merges open only their folders."""

import datetime as dt
import json
import os
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.config import JobsConfig
from lakestrata.operators import state as ST
from lakestrata.operators import weather as W
from lakestrata.operators.dedup import dedup_first
from lakestrata.plans.jobs_job import run_jobs
from lakestrata.plans.jobs_queries import scratch_database
from lakestrata.session import local_fs_path, scratch_path
from lakestrata.sources import held, ledger, tables
from lakestrata.streaming import streams as S

T = dt.datetime


def folder(spark, name):
    return local_fs_path(scratch_path(spark, name))


def posting(i, created):
    return {"id": i, "title": "t", "created": created}


def land(base, name, *pages):
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/{name}", "w") as f:
        f.write("\n".join(p if isinstance(p, str) else json.dumps(p) for p in pages))


def config(spark, **kw):
    return JobsConfig(database=scratch_database(spark, "ledger"), **kw)


def stored(spark, cfg):
    return sorted(r.job_id for r in spark.table(f"{cfg.database}.{cfg.table}").collect())


def test_a_bad_page_is_read_again_only_when_its_file_changes(spark):
    base, cfg = folder(spark, "landing"), config(spark)
    whole = {"results": [posting("b", "2024-02-01T00:00:00Z")]}
    land(base, "one [1] 100%.json", {"results": [posting("a", "2024-02-01T00:00:00Z")]})
    land(base, "two.json", {"results": [posting("c", "2024-02-02T00:00:00Z")]}, json.dumps(whole)[:30])
    first = run_jobs(spark, cfg, base, T(2024, 2, 3))
    assert (first["files_read"], first["quarantined_pages"], first["version"]) == (2, 1, 1)
    again = run_jobs(spark, cfg, base, T(2024, 2, 20))
    assert (again["files_read"], again["quarantined_pages"], again["files_still_bad"], again["version"]) == (0, 0, 1, 2)
    assert spark.table(f"{cfg.database}.{cfg.quarantine_table}").count() == 1
    time.sleep(1.1)
    land(base, "two.json", {"results": [posting("c", "2024-02-02T00:00:00Z")]}, whole)
    land(base, "three.json", {"results": [posting("old", "2024-01-01T00:00:00Z")]})
    third = run_jobs(spark, cfg, base, T(2024, 2, 21))
    # b lies weeks before the window of this run, but its file was first read for the window of the first
    assert (third["files_read"], third["quarantined_pages"], third["files_still_bad"], third["version"]) == (2, 0, 0, 3)
    assert stored(spark, cfg) == ["a", "b", "c"]
    rows = spark.table(f"{cfg.database}.{cfg.ledger_table}").select("file", "outcome").collect()
    assert sorted((r.file.rpartition("/")[2][:3], r.outcome) for r in rows) == [
        ("one", "loaded"), ("thr", "loaded"), ("two", "loaded"), ("two", "quarantined"), ("two", "replaced")]
    late = run_jobs(spark, cfg, base, T(2024, 3, 1))        # the window of the bad file is closed by now
    assert late["extraction_window_start"] == T(2024, 2, 20, 12) and late["files_read"] == 0


def test_the_state_can_wait_for_bad_files(spark):
    base, cfg = folder(spark, "landing"), config(spark, advance_over_quarantined=False)
    land(base, "p.json", {"results": [posting("a", "2024-02-01T00:00:00Z")]}, '{"results": [')
    assert [run_jobs(spark, cfg, base, T(2024, 2, d))["version"] for d in (3, 4)] == [0, 0]
    time.sleep(1.1)
    land(base, "p.json", {"results": [posting("a", "2024-02-01T00:00:00Z")]})
    assert run_jobs(spark, cfg, base, T(2024, 2, 5))["version"] == 1


def test_a_run_that_died_before_its_ledger_entry_is_repeated(spark, monkeypatch):
    base, cfg = folder(spark, "landing"), config(spark)
    land(base, "p.json", {"results": [posting("a", "2024-02-01T00:00:00Z")]}, '{"results": [')
    with monkeypatch.context() as m:
        m.setattr(ledger, "enter", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_jobs(spark, cfg, base, T(2024, 2, 3))
    receipt = run_jobs(spark, cfg, base, T(2024, 2, 3))
    assert (receipt["files_read"], receipt["jobs_processed"], receipt["quarantined_pages"]) == (1, 0, 0)
    assert stored(spark, cfg) == ["a"] and spark.table(f"{cfg.database}.{cfg.quarantine_table}").count() == 1


def test_postings_of_later_days_are_held_and_leave(spark):
    base, cfg = folder(spark, "landing"), config(spark)
    land(base, "p.json", {"results": [posting("a", "2024-02-01T00:00:00Z"), posting("b", "2024-02-05T10:00:00Z"),
                                      posting("c", "2024-02-05T20:00:00Z")]})
    for run, want in ((T(2024, 2, 2), ["a"]), (T(2024, 2, 5, 12), ["a", "b"]), (T(2024, 2, 7), ["a", "b", "c"])):
        run_jobs(spark, cfg, base, run)
        assert stored(spark, cfg) == want
    path = held.folder(spark, f"{cfg.database}.{cfg.table}", base)
    assert not [x for x in os.listdir(local_fs_path(path)) if x.startswith(held.DAY)]


def test_each_landing_is_read_by_itself(spark):
    one, two, cfg = folder(spark, "one"), folder(spark, "two"), config(spark)
    land(one, "p.json", {"results": [posting("a", "2024-02-01T00:00:00Z"), posting("later", "2024-02-04T00:00:00Z")]}, '{"results": [')
    land(two, "p.json", {"results": [posting("b", "2024-02-05T00:00:00Z"), posting("old", "2024-01-28T00:00:00Z")]})
    run_jobs(spark, cfg, one, T(2024, 2, 3))
    receipt = run_jobs(spark, cfg, two, T(2024, 2, 6))      # the other landing's bad file is not gone
    assert (receipt["files_read"], receipt["files_still_bad"]) == (1, 0) and stored(spark, cfg) == ["a", "b"]


def test_of_two_held_versions_the_later_one_is_stored(spark):
    table = f"{scratch_database(spark, 't_versions')}.jobs"
    rows = lambda *x: spark.createDataFrame(
        [(i, T(2030, 1, d), v) for i, d, v in x], "job_id string, ts timestamp_ntz, v int")
    run = lambda y: S.append_new_batch(table, "job_id", [], ts="ts", run_ts=T(y, 6, 1))
    run(2024)(rows(("a", 1, 1), ("b", 1, 1)), 0)
    run(2024)(rows(("a", 2, 2)), 1)
    run(2024)(rows(("a", 2, 2)), 1)                         # a replay
    run(2031)(rows(), 2)
    assert sorted((r.job_id, r.v) for r in spark.table(table).collect()) == [("a", 2), ("b", 1)]
    left = held.waiting(spark, held.folder(spark, table), rows().schema, "ts", T(2040, 1, 1))
    assert left is None or left.isEmpty()


def ts_rows(spark, n):
    return spark.createDataFrame([(T(2024, 1, 1, h),) for h in range(n)], "ts timestamp_ntz")


def versions(spark, table):
    return sorted((r.version, r.total_jobs_extracted) for r in spark.table(table).collect())


def test_a_batch_that_died_after_its_claim_goes_on(spark, monkeypatch):
    table = f"{scratch_database(spark, 't_dead')}.state"
    fn = S.versioned_state_batch(table, "p", "ts", "stream")
    fn(ts_rows(spark, 1), 0)
    with monkeypatch.context() as m:                        # the run dies: its claim stays
        m.setattr(S, "append_claimed", lambda row, t, i, v, fmt, owner: (
            ST.claim(spark, ST.claim_path(spark, t, i, v), owner), 1 / 0))
        with pytest.raises(ZeroDivisionError):
            fn(ts_rows(spark, 2), 1)
    fn(ts_rows(spark, 2), 1)
    fn(ts_rows(spark, 2), 1)
    assert versions(spark, table) == [(1, 1), (2, 3)]


def test_a_version_that_another_run_took_is_followed_by_the_next(spark, monkeypatch):
    table = f"{scratch_database(spark, 't_foreign')}.state"
    fn = S.versioned_state_batch(table, "p", "ts", "stream")
    fn(ts_rows(spark, 1), 0)
    with monkeypatch.context() as m:                        # logged for version 2, then dead
        m.setattr(S, "append_claimed", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fn(ts_rows(spark, 1), 1)
    ST.commit_state(spark, table, "p", 1, T(2024, 1, 2), 100)
    fn(ts_rows(spark, 1), 1)
    fn(ts_rows(spark, 1), 1)
    assert versions(spark, table) == [(1, 1), (2, 101), (3, 102)]


def test_a_dead_claim_is_taken_over_by_its_owner_at_once_and_by_others_when_it_is_old(spark):
    table = f"{scratch_database(spark, 't_stale')}.state"
    ST.commit_state(spark, table, "p", 0, T(2024, 1, 1), 5)
    ST.claim(spark, ST.claim_path(spark, table, "p", 2), "dead run")
    with pytest.raises(ST.VersionConflict):
        ST.commit_state(spark, table, "p", 1, T(2024, 1, 2), 5)
    assert ST.commit_state(spark, table, "p", 1, T(2024, 1, 2), 5, run_id="dead run") == 2
    ST.claim(spark, ST.claim_path(spark, table, "p", 3), "dead run")
    assert ST.commit_state(spark, table, "p", 2, T(2024, 1, 3), 5, stale_after=dt.timedelta(0)) == 3
    assert versions(spark, table) == [(1, 5), (2, 10), (3, 15)]


def test_a_merge_opens_the_batchs_folders_only(spark):
    path = folder(spark, "hours")
    hours = spark.range(1000).select(F.col("id").alias("site"), F.lit(1).alias("v"), F.lit("2024").alias("year"),
                                     F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0").alias("month"),
                                     F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0").alias("day"))
    parts = ["year", "month", "day"]
    tables.overwrite_partitions(hours, path, parts)
    batch = hours.where("id = 0").withColumn("v", F.lit(2))
    stored = tables.stored_rows(spark, path, hours.schema, "parquet")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = tables.in_partitions(stored, batch, parts)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert all(f"({c}#" in filters for c in parts) and " = 2024)" in filters and " = 01)" in filters
    assert tables.in_partitions(stored, batch, parts).select(
        F.regexp_extract("_metadata.file_path", "year=.*/", 0)).distinct().count() == 1
    names = lambda: {f for _, _, fs in os.walk(path) for f in fs if f.startswith("part-")}
    before = names()
    tables.merge_partitions(batch, path, parts, ["site"])
    assert len(before - names()) <= 8 and len(before & names()) >= len(before) - 8
    rows = spark.read.schema(hours.schema).parquet(path)
    assert rows.count() == 1000 and [r.site for r in rows.where("v = 2").collect()] == [0]


def test_null_partitions_and_nested_rows_are_merged_alike_in_any_order(spark):
    schema = "p string, k int, s struct<a:int,b:string>, l array<int>, m map<string,int>"
    one, two = (None, 1, (1, "x"), [1, 2], {"a": 1}), (None, 1, (1, "y"), [1], {"b": 2})
    got = []
    for rows in ([one, two], [two, one]):
        path = folder(spark, "nested")
        tables.merge_partitions(spark.createDataFrame([("q", 2, None, None, None)], schema), path, ["p"], ["k"])
        for _ in range(2):
            tables.merge_partitions(spark.createDataFrame(rows, schema).coalesce(1), path, ["p"], ["k"])
        got.append(sorted(map(str, spark.read.schema(schema).parquet(path).collect())))
    assert got[0] == got[1] and len(got[0]) == 2


def test_an_upsert_leaves_the_files_of_other_folders(spark):
    path = folder(spark, "latest")
    rows = spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit(5).alias("t"), F.lit("a").alias("v"))
    tables.upsert_latest_rows(rows, path, "k", ["t"], 8)
    files = lambda: {f"{d[len(path):]}/{f}" for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}
    before = files()
    new = spark.createDataFrame([("7", 6, "b"), ("7", 4, "c")], "k string, t int, v string")
    tables.upsert_latest_rows(new, path, "k", ["t"], 8)
    assert len({f.split("/")[1] for f in before ^ files()}) == 1
    tables.upsert_latest_rows(spark.createDataFrame([("7", 5, "old"), (None, 1, "x"), (None, 1, "x")], "k string, t int, v string"),
                              path, "k", ["t"], 8)
    stored = spark.read.schema("k string, t int, v string").parquet(path)
    assert stored.count() == 402 and [(r.t, r.v) for r in stored.where("k = '7'").collect()] == [(6, "b")]
    with pytest.raises(ValueError, match="number of parts"):
        tables.upsert_latest_rows(new, path, "k", ["t"], 16)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAé\x00\U0001F600zb ", max_size=4)), min_size=1, max_size=12))
def test_descending_strings_and_bytes_without_a_window(spark, values):
    df = spark.createDataFrame([(1, v, None if v is None else v.encode()) for v in values], "k int, s string, b binary")
    key = lambda v: (v is not None, (v or "").encode())
    for c in ("s", "b"):
        best = dedup_first(df, ["k"], [(c, "desc")])
        assert "Window" not in best._jdf.queryExecution().executedPlan().toString()
        assert best.first()["s"] == max(values, key=key)


@pytest.mark.parametrize("mode", ["time", "range"])
def test_as_of_with_fallback(spark, mode):
    import random
    rng = random.Random(2)
    at = lambda: T(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 24 * 40))
    events = [(rng.choice("abc"), at(), k) for k in range(80)] + [("hot", T(2024, 1, 20, 5), k) for k in range(40)]
    anchors = [(rng.choice(["a", "b", "c", "hot", "none"]), at()) for _ in range(120)] + [(None, at()), ("a", None)]
    got = W.asof_backward(spark.createDataFrame(anchors, "k string, at timestamp_ntz"),
                          spark.createDataFrame(events, "k string, ts timestamp_ntz, v int"), ["k"], "at", "ts",
                          partitioning=mode, num_ranges=7, forward=True).select("k", "at", "ts", "v").collect()
    want = []
    for k, a in anchors:
        own = [(t, v) for x, t, v in events if x == k and k and a]
        back = [x for x in own if x[0] <= a]
        if own:
            first = min(t for t, _ in own)
            want.append((k, a, *(max(back) if back else max(x for x in own if x[0] == first))))
    assert sorted(map(tuple, got)) == sorted(want)
