"""Driver contract: entry smoke, and every key of the library has an oracle."""

import __spark_entry__ as E
from lakestrata.plans import registry


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["genre", "movie_count", "avg_budget", "avg_box_office", "avg_rating"]
    assert len(rows) == 3


def test_keys_have_oracles():
    registry.load_all()
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and set(registry.QUERIES) <= set(qs)
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_receipts_count_the_files(spark, smoke_dir):
    from pyspark.sql import functions as F
    from lakestrata.plans.jobs_queries import scratch_database
    from lakestrata.sources import tables
    name = f"{scratch_database(spark, 't_receipt')}.t"
    rows = spark.range(0, 1000, 1, 4).select(F.col("id").cast("string").alias("job_id"), F.lit(1).alias("d"))
    first = tables.append_new(rows, name, "job_id", partition_by=["d"], run_marker={"d": 1}, max_records_per_file=300)
    files = spark.table(name).select("_metadata.file_path").distinct().count()
    assert (first.new_jobs, first.files_written, first.table_updated) == (1000, files, True) and files >= 4
    again = tables.append_new(rows, name, "job_id", partition_by=["d"], run_marker={"d": 1})
    assert (again.new_jobs, again.files_written, again.table_updated) == (0, 0, False)
    receipts = {r["run"]: r for r in E.queries()["load_receipt"](spark, smoke_dir).collect()}
    assert 0 < receipts[2]["new_jobs"] < receipts[1]["new_jobs"]
