"""Plan properties that must hold at any scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lakestrata.plans.jobs_queries import scratch_database
from lakestrata.sources import tables

SMOKE_DIR = "/root/testdata/sf0.001"
PURE_KEYS = ["genre_metrics", "gold_grouping_sets", "jobs_clean", "jobs_upsert_latest",
             "state_default", "jobs_window_from_state", "arrays_zip_roundtrip", "asof_backward",
             "month_load_report", "partition_pruned_scan", "weather_nearest_hour"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", PURE_KEYS)
def test_no_pairs_no_python(spark, key):
    plan = plan_of(E.queries()[key](spark, SMOKE_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan


def test_partition_filters_reach_the_scan(spark):
    plan = plan_of(E.queries()["partition_pruned_scan"](spark, SMOKE_DIR))
    assert "PartitionFilters: [isnotnull(year" in plan and "(day" in plan
    assert "props" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_gold_scan_reads_only_used_columns(spark):
    plan = plan_of(E.queries()["genre_metrics"](spark, SMOKE_DIR))
    read = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "l_discount" not in read and "l_tax" not in read and "l_linestatus" not in read


def test_bucketed_table_side_is_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        db = scratch_database(spark, "t_bucket")
        stored = spark.range(1000).select(F.col("id").cast("string").alias("job_id"),
                                          F.lit(1).alias("d"))
        tables.append_new(stored, f"{db}.t", "job_id", partition_by=["d"], bucket_by=(4, "job_id"))
        batch = spark.range(900, 1100).select(F.col("id").cast("string").alias("job_id"),
                                              F.lit(2).alias("d"))
        plan = plan_of(tables.new_only(batch, spark.table(f"{db}.t"), "job_id"))
        assert "Bucketed: true" in plan
        # the batch's rows and its keys move; nothing between the stored scan and its join does
        stored_side = [x for x in plan.split("SortMergeJoin") if "Bucketed: true" in x][-1]
        assert "Exchange" not in stored_side.split("FileScan parquet")[0].split("LeftSemi")[-1].split("Range")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_batch_is_broadcast_against_the_stored_keys(spark):
    db = scratch_database(spark, "t_plain")
    stored = spark.range(20000).select(F.col("id").cast("string").alias("job_id"), F.lit(1).alias("d"))
    tables.append_new(stored, f"{db}.t", "job_id", partition_by=["d"])
    batch = spark.range(19990, 20010).select(F.col("id").cast("string").alias("job_id"), F.lit(2).alias("d"))
    found = tables.new_only(batch, spark.table(f"{db}.t"), "job_id")
    assert found.count() == 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(i for i, x in enumerate(plan.splitlines()) if "FileScan parquet" in x)
    above = plan.splitlines()[:scan]
    join = max(i for i, x in enumerate(above) if "LeftSemi" in x)
    assert not any("Exchange" in x for x in above[join:])         # the stored side is not shuffled
