"""Dedup in the state store: bounded state, late rows in the side table, nothing lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakestrata.session import scratch_path
from lakestrata.streaming import streams as S
from lakestrata.streaming import watermark as WM

SCHEMA = "id string, ts timestamp_ntz, v int"
DAY0 = dt.datetime(2024, 1, 1)


class Feed:
    def __init__(self, spark, overlap="12 hours"):
        self.spark, self.overlap = spark, overlap
        self.landing, self.ckpt, self.sink = (scratch_path(spark, f"wm_{x}") for x in ("landing", "ckpt", "sink"))
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def land(self, rows):
        self.spark.createDataFrame([(i, None if h is None else DAY0 + dt.timedelta(hours=h), v) for i, h, v in rows],
                                   SCHEMA).coalesce(1).write.mode("append").parquet(self.landing)

    def run(self):
        return WM.dedup_run(S.file_stream(self.spark, self.landing, self.schema), self.ckpt, self.sink, "id", "ts", self.overlap)

    def result(self):
        return tuple(sorted((str(r["id"]), r["v"]) for r in f(self.spark, self.sink, self.schema).collect())
                     for f in (WM.stored_rows, WM.late_rows))


def test_overlap_is_dropped_and_late_rows_are_kept_apart(spark):
    feed = Feed(spark)
    feed.land([("a", 1, 1), ("b", 20, 1), (None, 20, 1), (None, 20, 1), ("n", None, 1)])
    first = feed.run()
    assert first.watermark_ms == 0
    feed.land([("b", 21, 2), ("c", 30, 1), ("old", 8, 1), ("old", 8, 2), ("a", 1, 2), ("edge", 9, 1)])
    second = feed.run()
    assert second.watermark_ms == int((DAY0 + dt.timedelta(hours=8) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    stored, late = feed.result()
    assert stored == [("None", 1), ("None", 1), ("a", 1), ("b", 1), ("c", 1), ("edge", 1)]
    assert late == [("a", 2), ("n", 1), ("old", 1), ("old", 2)]
    assert feed.run().rows == 0 and feed.result() == (stored, late)


def test_state_is_bounded_over_ten_runs(spark):
    feed = Feed(spark, "24 hours")
    sizes = []
    for day in range(10):
        again = [(f"{day - 1}-{k}", 24 * day - 1, 2) for k in range(50)] if day else []
        feed.land([(f"{day}-{k}", 24 * day + k % 24, 1) for k in range(100)] + again + [(f"late-{day}", -99, 1)])
        sizes.append(feed.run().state_rows)
    stored, late = feed.result()
    assert len(stored) + len(late) == 10 * 100 + 10 and all(v == 1 for _, v in stored)
    assert len(late) == 9                                        # the first run has no watermark yet
    assert max(sizes) <= 350 and sizes[-1] <= 350


def test_a_crashed_run_is_repeated_from_the_same_watermark(spark):
    feed = Feed(spark)
    feed.land([("a", 40, 1)])
    feed.run()
    feed.land([("b", 50, 1), ("x", 3, 1)])
    broken = S.file_stream(spark, feed.landing, feed.schema).withColumn(
        "v", F.when(F.col("id") == "x", F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("v")))
    mark = WM.reached(spark, feed.ckpt)
    with pytest.raises(Exception, match="boom"):                 # the batch is planned, not committed
        WM.dedup_run(broken, feed.ckpt, feed.sink, "id", "ts", feed.overlap)
    assert WM.reached(spark, feed.ckpt) == mark > 0
    feed.land([("c", 60, 1), ("y", 30, 1)])                      # a second batch after the repeated one
    feed.run()
    assert feed.result() == ([("a", 1), ("b", 1), ("c", 1), ("y", 1)], [("x", 1)])


def test_bad_parameters_are_refused(spark):
    feed = Feed(spark, "1 month")
    feed.land([("a", 1, 1)])
    with pytest.raises(ValueError, match="overlap"):
        feed.run()
    clash = spark.readStream.schema("id string, ts timestamp, outcome string").parquet(feed.landing)
    with pytest.raises(ValueError, match="outcome"):
        WM.dedup_run(clash, feed.ckpt, feed.sink, "id", "ts", "1 hour")
