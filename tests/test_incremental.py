"""Gold kept up to date batch by batch, and pages found by cursor."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import films as ops
from lakestrata.operators import jobs as J
from lakestrata.plans import films_job
from lakestrata.session import checkpoint_root, local_fs_path, scratch_path
from lakestrata.sources import tables

FILM = ("id long, rating string, release_date string, genre string, studio string, budget double, "
        "box_office double, vote_average double, version int")
ORDER = [("version", "desc"), "genre", "studio", "rating", "release_date", "budget", "box_office", "vote_average"]


def films(rng, n):
    def some(*values):
        return rng.choice([*values, None])
    return [(some(*range(12)), some("G", "X"), some("2020-01-01", "2021-05-05", "junk", ""), some("Drama", "Comedy"),
             some("A", "B", ""), some(10.25, 0.005, 3.0), some(7.77, 100.0), some(5.5, 6.0), rng.randint(0, 4))
            for _ in range(n)]


def config(spark, parts=3):
    root = scratch_path(spark, "incremental")
    return films_job.IncrementalConfig(f"{root}/silver", f"{root}/states", ORDER, parts)


def rows_of(df):
    return sorted(map(str, df.collect()))


def full(spark, rows):
    return ops.gold_grouping_sets(ops.silver(spark.createDataFrame(rows, FILM), "id", ORDER))


def test_gold_of_batches_equals_the_full_recompute(spark):
    rng = random.Random(3)
    for _ in range(2):
        cfg, seen = config(spark), []
        for batch_id, n in enumerate([9, 0, 14, 5]):
            batch = films(rng, n)
            seen += batch
            films_job.run_films_batch(spark, spark.createDataFrame(batch, FILM), batch_id, cfg)
            got, want = films_job.gold_of_batches(spark, cfg), full(spark, seen)
            assert got.columns == want.columns and got.dtypes == want.dtypes
            assert rows_of(got) == rows_of(want)


def test_a_batch_that_died_is_run_again(spark, monkeypatch):
    rng = random.Random(5)
    cfg, first, second = config(spark), films(rng, 20), films(rng, 20)
    films_job.run_films_batch(spark, spark.createDataFrame(first, FILM), 1, cfg)
    whole = tables.overwrite_partitions

    def dies(*args, **kw):
        raise OSError("executor lost")
    with monkeypatch.context() as m:                    # states written, silver not
        m.setattr(tables, "overwrite_partitions", dies)
        with pytest.raises(OSError):
            films_job.run_films_batch(spark, spark.createDataFrame(second, FILM), 2, cfg)

    def dies_after(*args, **kw):
        whole(*args, **kw)
        raise OSError("driver lost")
    with monkeypatch.context() as m:                    # both written, the run is told that it failed
        m.setattr(tables, "overwrite_partitions", dies_after)
        with pytest.raises(OSError):
            films_job.run_films_batch(spark, spark.createDataFrame(second, FILM), 2, cfg)
    films_job.run_films_batch(spark, spark.createDataFrame(second, FILM), 2, cfg)
    assert rows_of(films_job.gold_of_batches(spark, cfg)) == rows_of(full(spark, first + second))


def test_states_without_their_mark_are_written_again(spark):
    rng = random.Random(6)
    cfg, rows = config(spark), films(rng, 15)
    junk = ops.gold_states(spark.createDataFrame(rows[:4], FILM).withColumn("release_year", F.lit(1))
                           .withColumn("_weight", F.lit(1)))
    junk.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{cfg.states_path}/batch=0")
    assert not tables.is_complete(spark, f"{cfg.states_path}/batch=0")
    films_job.run_films_batch(spark, spark.createDataFrame(rows, FILM), 0, cfg)
    assert rows_of(films_job.gold_of_batches(spark, cfg)) == rows_of(full(spark, rows))


def test_a_batch_opens_only_its_folders_and_gold_only_states(spark):
    cfg = config(spark, parts=50)
    rng = random.Random(7)
    rows = [(i, *films(rng, 1)[0][1:]) for i in range(300)]
    films_job.run_films_batch(spark, spark.createDataFrame(rows, FILM), 0, cfg)
    before = {r[0] for r in spark.read.parquet(cfg.silver_path).select("_metadata.file_path").distinct().collect()}
    films_job.run_films_batch(spark, spark.createDataFrame([(7, *rows[7][1:8], 99)], FILM), 1, cfg)
    after = {r[0] for r in spark.read.parquet(cfg.silver_path).select("_metadata.file_path").distinct().collect()}
    assert len(before - after) == 1
    assert all("/states/" in f for f in films_job.gold_of_batches(spark, cfg).inputFiles())


def files_kept(spark):
    """Files below the checkpoint folder, and shuffle files."""
    root = local_fs_path(checkpoint_root(spark))
    shuffles = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return ({os.path.join(d, f) for d, _, names in os.walk(root) for f in names},
            {f for f in shuffles if "shuffle_" in f})


def test_a_batch_leaves_nothing_on_disk_but_silver_and_states(spark, monkeypatch):
    rng = random.Random(9)
    cfg = config(spark)

    def left(batch_id):
        batch, before = spark.createDataFrame(films(rng, 40), FILM), files_kept(spark)
        try:
            films_job.run_films_batch(spark, batch, batch_id, cfg)
        finally:
            after = files_kept(spark)
        own = tuple(local_fs_path(p) + "/" for p in (cfg.silver_path, cfg.states_path))
        return [f for f in after[0] - before[0] if not f.startswith(own)] + sorted(after[1] - before[1])
    assert left(0) == left(1) == left(1) == []

    def dies(*args, **kw):
        raise OSError("executor lost")
    before = files_kept(spark)
    monkeypatch.setattr(tables, "overwrite_partitions", dies)
    with pytest.raises(OSError):
        left(2)
    gone = tuple(local_fs_path(p) + "/" for p in (cfg.silver_path, cfg.states_path))
    after = files_kept(spark)
    assert all(f.startswith(gone) for f in after[0] - before[0]) and after[1] <= before[1]


def test_a_large_batch_is_merged_in_slices_of_the_folders(spark, monkeypatch):
    """A group's shuffle holds its own folders only; together they hold every row once."""
    rng = random.Random(10)
    cores = spark.sparkContext.defaultParallelism
    cfg, seen, merged, whole = config(spark, parts=8 * cores), [], [], films_job.dedup_sides

    def sides(new, old, *args):
        merged.append([{r.id for r in side.select("id").collect()} for side in (new, old)])
        return whole(new, old, *args)
    monkeypatch.setattr(films_job, "dedup_sides", sides)
    for batch_id in range(3):
        batch = [(None if i % 100 == 0 else rng.randint(0, 40 * cores), *films(rng, 1)[0][1:-1], v)
                 for i, v in enumerate(rng.sample(range(10**6), 100 * cores))]
        stored = {r[0] for r in seen}
        seen += batch
        films_job.run_films_batch(spark, spark.createDataFrame(batch, FILM), batch_id, cfg)
        got, merged[:] = list(merged), []
        assert len(got) == cfg.slices
        for side, ids in ((0, {r[0] for r in batch}), (1, stored)):
            met = set().union(*(g[side] for g in got))
            assert sum(len(g[side]) for g in got) == len(met)
            assert met == ids if side == 0 else met <= ids      # folders that the batch doesn't touch are not read
            assert not batch_id or max(len(g[side]) for g in got) < 0.5 * len(ids)
        assert rows_of(films_job.gold_of_batches(spark, cfg)) == rows_of(full(spark, seen))
    names = [c.split()[0] for c in FILM.split(", ")]
    silver = ops.silver(spark.createDataFrame(seen, FILM), "id", ORDER).select(names)
    assert rows_of(spark.read.schema(silver.schema).parquet(cfg.silver_path).select(names)) == rows_of(silver)


def pages_of(df, size):
    cursor, out = None, []
    while True:
        page = J.page_after(df, cursor, size).collect()
        if not page:
            return out
        out.append(page)
        cursor = J.cursor_of(page, cursor)


def test_pages_by_cursor_show_every_row_once(spark):
    rng = random.Random(8)
    days = [dt.datetime(2024, 1, d, 3, 4, 5, 600) for d in range(1, 5)]
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([*days, None]), rng.randint(0, 2)) for _ in range(97)]
    rows += [("a", days[0], 1)] * 23                    # more equal rows than a page holds
    df = spark.createDataFrame(rows, "job_id string, job_created timestamp_ntz, extra int").repartition(5).checkpoint()
    pages = pages_of(df, 11)
    got = [tuple(r) for p in pages for r in p]
    assert [len(p) for p in pages] == [11] * 10 + [10]
    assert sorted(got, key=str) == sorted(rows, key=str)
    in_order = [(r.job_id, r.job_created) for r in df.orderBy(
        F.col("job_created").desc_nulls_last(), F.col("job_id").asc_nulls_last()).collect()]
    assert [g[:2] for g in got] == in_order
    assert pages_of(df.limit(0), 11) == [] and J.cursor_of([]) is None


def test_the_cursor_reaches_the_scan_and_a_task_keeps_a_page(spark, capsys):
    path = scratch_path(spark, "pages")
    (spark.range(20000).selectExpr("cast(id as string) as job_id",
                                   "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id) as job_created")
     .write.parquet(path))
    df = spark.read.parquet(path)
    last = J.latest_page(df, 200).collect()
    before = J.cursor_of(J.latest_page(df, 199).collect())
    page = J.page_after(df, before)
    assert [tuple(r) for r in page.collect()] == [tuple(r) for r in last]
    page.explain("formatted")
    plan = capsys.readouterr().out
    assert "LessThan(job_created" in plan and "TakeOrderedAndProject" in plan
