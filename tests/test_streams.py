"""foreachBatch sinks are idempotent per batch id; a stream run equals the batch run."""

import datetime as dt

from lakestrata.streaming import streams as S
from lakestrata.plans.jobs_queries import scratch_database
from lakestrata.session import scratch_path

import __spark_entry__ as E


def test_state_commit_replay_is_noop(spark):
    db = scratch_database(spark, "t_state")
    table = f"{db}.state"
    fn = S.versioned_state_batch(table, "p", "ts", "checkpoint-1")
    b0 = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),)], "ts timestamp_ntz")
    b1 = spark.createDataFrame([(dt.datetime(2024, 1, 2, 5),), (dt.datetime(2024, 1, 2, 6),)],
                               "ts timestamp_ntz")
    fn(b0, 0)
    fn(b0, 0)          # replay after a failure between sink and commit log
    fn(b1, 1)
    rows = sorted((r["version"], r["total_jobs_extracted"]) for r in spark.table(table).collect())
    assert rows == [(1, 1), (2, 3)]
    again = S.versioned_state_batch(table, "p", "ts", "checkpoint-2")      # batch ids start anew
    again(b0, 0)
    again(b0, 0)
    rows = sorted((r["version"], r["total_jobs_extracted"], r["last_extraction_time"]) for r in spark.table(table).collect())
    assert rows[2] == (3, 4, dt.datetime(2024, 1, 2, 6)) and len(rows) == 3


def test_of_two_commits_over_one_version_one_is_refused(spark):
    from concurrent.futures import ThreadPoolExecutor
    from lakestrata.operators import state as ST
    table = f"{scratch_database(spark, 't_race')}.state"
    ST.commit_state(spark, table, "p", 0, dt.datetime(2024, 1, 1), 5)

    def commit(n):
        try:
            return ST.commit_state(spark, table, "p", 1, dt.datetime(2024, 1, 2), n)
        except ST.VersionConflict:
            return "refused"
    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(commit, range(4)))
    assert sorted(map(str, results)) == ["2", "refused", "refused", "refused"]
    assert sorted(r["version"] for r in spark.table(table).collect()) == [1, 2]


def test_future_rows_wait_and_late_rows_are_stored(spark):
    table = f"{scratch_database(spark, 't_future')}.jobs"
    rows = lambda *x: spark.createDataFrame(
        [(i, dt.datetime(y, 1, 1)) for i, y in x], "job_id string, ts timestamp_ntz")
    run = lambda y: S.append_new_batch(table, "job_id", [], ts="ts", run_ts=dt.datetime(y, 6, 1))
    run(2024)(rows(("a", 2030), ("b", 2024)), 0)
    run(2024)(rows(("c", 2024), ("d", 2001)), 1)
    assert sorted(r["job_id"] for r in spark.table(table).collect()) == ["b", "c", "d"]
    run(2030)(rows(("b", 2025)), 2)
    assert sorted((r["job_id"], r["ts"].year) for r in spark.table(table).collect()) == [
        ("a", 2030), ("b", 2024), ("c", 2024), ("d", 2001)]


def test_a_batch_with_one_id_twice_stores_it_once(spark):
    table = f"{scratch_database(spark, 't_twice')}.jobs"
    S.append_new_batch(table, "job_id", ["d"])(spark.createDataFrame(
        [("a", 1), ("a", 2), (None, 1), (None, 1)], "job_id string, d int"), 0)
    assert sorted(str(r["job_id"]) for r in spark.table(table).collect()) == ["None", "None", "a"]


def test_append_new_batch_replay_adds_nothing(spark):
    db = scratch_database(spark, "t_append")
    table = f"{db}.jobs"
    fn = S.append_new_batch(table, "job_id", ["d"])
    batch = spark.createDataFrame([("a", 1), ("b", 1)], "job_id string, d int")
    fn(batch, 0)
    fn(batch, 0)
    assert spark.table(table).count() == 2


def test_an_hour_in_two_batches_keeps_both(spark):
    path = scratch_path(spark, "t_hours")
    fn = S.merge_hours_batch(path, ["hour"], ["site"], latest=["v"])
    rows = lambda *x: spark.createDataFrame(list(x), "site int, v int, hour string")
    fn(rows((1, 1, "00"), (2, 1, "01")), 0)
    fn(rows((3, 1, "00"), (2, 2, "01"), (2, 1, "01")), 1)
    fn(rows((3, 1, "00"), (2, 2, "01"), (2, 1, "01")), 1)
    fn(rows(), 2)
    stored = spark.read.schema("site int, v int, hour string").parquet(path)
    assert sorted(map(tuple, stored.collect())) == [(1, 1, "00"), (2, 2, "01"), (3, 1, "00")]


def test_stream_equals_batch(spark, smoke_dir):
    qs = E.queries()
    rows = lambda df: sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())
    assert rows(qs["stream_jobs_available_now"](spark, smoke_dir)) == rows(qs["jobs_clean"](spark, smoke_dir))
    stream_upsert = qs["stream_jobs_upsert"](spark, smoke_dir)
    batch_upsert = qs["jobs_upsert"](spark, smoke_dir).drop("job_salary")
    assert rows(stream_upsert) == rows(batch_upsert)
