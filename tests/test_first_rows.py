"""First rows of groups: each value travels once, and rows meet their stored versions in one aggregate."""

import random

from pyspark.sql import functions as F

from lakestrata.operators.dedup import dedup_first, dedup_sides
from lakestrata.plans import films_job
from lakestrata.session import scratch_path

ROW = "k long, s string, d double, t timestamp_ntz, n long, m map<string,int>"


def rows(rng, n):
    import datetime as dt

    def some(*values):
        return rng.choice([*values, None])
    return [(some(1, 2, 3), some("", "a", "ab", "é"), some(0.5, float("-inf"), 2.0), some(dt.datetime(2024, 1, 1), dt.datetime(1960, 1, 1)),
             some(-2**63, 5), some({"x": 1})) for _ in range(n)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan_of(df).split("Initial Plan")[-1].count("Exchange hashpartitioning")


def test_every_order_finds_the_row_that_a_window_finds(spark):
    rng = random.Random(11)
    df = spark.createDataFrame(rows(rng, 80), ROW).withColumn("u", F.monotonically_increasing_id()).checkpoint()
    plain = df.drop("m")
    for frame in (df, plain):
        for _ in range(4):
            order = [(c, rng.choice(["asc", "desc"]), rng.choice([True, False])) for c in rng.sample(["s", "d", "t", "n"], 4)]
            for o in ([*order, "u"], [(c, "desc", last) for c, _, last in order] + [("u", "desc")]):
                assert sorted(map(str, dedup_first(frame, ["k"], o).collect())) \
                    == sorted(map(str, dedup_first(frame, ["k"], o, method="window").collect()))


def test_strings_that_descend_are_not_complemented_and_travel_once(spark):
    df = spark.createDataFrame([(1, "a", "b"), (1, "c", "d")], "k int, s string, v string")
    best = dedup_first(df, ["k"], [("s", "desc"), ("v", "desc")])
    assert "translate" not in plan_of(best) and "max_by" not in plan_of(best)
    assert [tuple(r) for r in best.collect()] == [(1, "c", "d")]
    aggregate = next(line for line in plan_of(best).splitlines() if "partial_max" in line)
    assert "r0" not in aggregate                # no part of the row beside its place


def test_both_sides_in_one_aggregate(spark):
    rng = random.Random(12)
    for cut in (ROW, None):
        df = spark.createDataFrame(rows(rng, 60), ROW).withColumn("u", F.monotonically_increasing_id()).checkpoint()
        df = df if cut else df.drop("m")
        new, old = df.where("u % 3 = 0"), dedup_first(df.where("u % 3 = 1 and k <=> 2 or u % 3 = 2 and k = 3"), ["k"], ["u"])
        got = dedup_sides(new, old, ["k"], [("t", "desc"), "s", "u"])
        assert exchanges(got) - exchanges(old) == 1 and "Join" not in plan_of(got)
        want = dedup_first(new.unionByName(old), ["k"], [("t", "desc"), "s", "u"])
        assert sorted(map(str, got.select(*df.columns).collect())) == sorted(map(str, want.collect()))
        came = {r.k for r in new.collect()}
        stored = {r.k: r.u for r in old.collect()}
        assert {r.k: r._came for r in got.collect()} == {k: k in came for k in came | set(stored)}
        assert {r.k: r._old.u for r in got.collect() if r._old} == stored


def test_a_batch_of_films_is_dealt_out_twice_at_most(spark, monkeypatch):
    """Once for survivors and once for gold: silver is written from where its rows are, one file a folder."""
    from lakestrata.sources import tables
    root, parts = scratch_path(spark, "dealt"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    cfg = films_job.IncrementalConfig(f"{root}/silver", f"{root}/states", [("version", "desc")], parts)
    films = spark.range(500).selectExpr("id", "'G' rating", "'2020-01-01' release_date", "'x' genre", "'y' studio", "1d budget",
                                        "2d box_office", "3d vote_average", "1 version").repartition(3)
    written = []
    whole = tables.overwrite_partitions
    monkeypatch.setattr(tables, "overwrite_partitions", lambda df, *a, **k: (written.append(plan_of(df)), whole(df, *a, **k)))
    for batch_id in (0, 1):
        films_job.run_films_batch(spark, films.withColumn("version", F.lit(batch_id)), batch_id, cfg)
    assert all("Exchange" not in p for p in written)
    files = spark.read.parquet(cfg.silver_path).groupBy(tables.part_column(parts)).agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert {r.n for r in files.collect()} == {1}


def test_an_upsert_deals_rows_out_once(spark, monkeypatch):
    """Batch and stored rows meet in one aggregate over plain strings; rows without a key stay beside it, twice over."""
    from lakestrata.sources import tables
    path, parts = scratch_path(spark, "upsert"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(600).selectExpr("if(id < 3, null, concat('J', id)) job_id", "cast(id % 5 as string) title", "1 t").repartition(3)
    found, whole = [], tables.dedup_first

    def dedup(df, *args):
        out = whole(df, *args)
        found.append((exchanges(out), plan_of(out)))
        return out
    monkeypatch.setattr(tables, "dedup_first", dedup)
    for t in (1, 3, 2):
        tables.upsert_latest_rows(rows.withColumn("t", F.lit(t)), path, "job_id", ["t"], parts)
    assert len(found) == 3 and all(n == 1 and "translate" not in p and "Join" not in p for n, p in found)
    stored = spark.read.schema(rows.schema).parquet(path)
    assert stored.where("job_id is null").count() == 9
    assert stored.where("job_id is not null").select("t").distinct().collect() == [(3,)]
    assert stored.where("job_id is not null").count() == 597 == stored.select("job_id").where("job_id is not null").distinct().count()
