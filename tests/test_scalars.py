"""Scalar helpers: names, zone offsets, literals, size-checked broadcast."""

import datetime as dt

from pyspark.sql import functions as F

from lakestrata.functions import scalars as S


def test_sanitize_name():
    assert S.sanitize_name("Part Key") == "part_key"
    assert S.sanitize_name("partName") == "part_name"
    assert S.sanitize_name("Retail Price €") == "retail_price"
    assert S.sanitize_name("Année-Été") == "annee_ete"
    assert S.sanitize_name("__x__") == "x"


def test_iso_offsets_any_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 12, 0),), (dt.datetime(2024, 7, 1, 3, 30),)],
                               "ts timestamp_ntz")
    got = [tuple(r) for r in df.select(
        S.iso_local("ts", "Africa/Johannesburg"), S.iso_local("ts", "America/New_York"),
        S.iso_local("ts", "Asia/Kolkata")).collect()]
    assert got[0] == ("2024-01-15T14:00:00+02:00", "2024-01-15T07:00:00-05:00",
                      "2024-01-15T17:30:00+05:30")
    assert got[1][1] == "2024-06-30T23:30:00-04:00"          # daylight saving time


def test_ts_lit_is_wall_clock(spark):
    v = spark.range(1).select(S.ts_lit(dt.datetime(2024, 3, 10, 2, 30)).alias("t")).first()["t"]
    assert v == dt.datetime(2024, 3, 10, 2, 30)


def test_local_round_trip(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 22, 5),)], "ts timestamp_ntz")
    r = df.select(S.utc_to_local("ts", "Africa/Johannesburg").alias("l")) \
          .select("l", S.local_to_utc("l", "Africa/Johannesburg").alias("u")).first()
    assert r["l"] == dt.datetime(2024, 1, 16, 0, 5) and r["u"] == dt.datetime(2024, 1, 15, 22, 5)


def test_partition_paths(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 7, 0),)], "ts timestamp_ntz")
    r = df.select(S.daily_partition_path("ts").alias("d"), S.hourly_partition_path("ts").alias("h")).first()
    assert r["d"] == "historical/year=2024/month=03/weather_data.json"
    assert r["h"] == "current/year=2024/month=03/day=05/hour=07/weather_data.json"
