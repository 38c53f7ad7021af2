"""Registered queries of the scalar helpers on driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_LOCAL_TIMEZONE as TZ
from ..functions import scalars as S
from ..sources.testdata import table
from .registry import register

# Africa/Johannesburg has kept UTC+2 without daylight saving since 1944, so
# the oracle may add two hours.


@register("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
       CAST(hour(o_orderdate) AS INTEGER) AS hour
FROM orders""")
def date_parts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", *S.date_parts("o_orderdate"))


@register("partition_path", """
SELECT event_id,
       strftime(ts, 'historical/year=%Y/month=%m/weather_data.json') AS daily_path,
       strftime(ts + INTERVAL 2 HOUR, 'current/year=%Y/month=%m/day=%d/hour=%H/weather_data.json') AS hourly_path
FROM events""")
def partition_path(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", S.daily_partition_path("ts").alias("daily_path"),
                     S.hourly_partition_path(S.utc_to_local("ts", TZ)).alias("hourly_path"))


@register("local_time_convert", """
SELECT event_id, ts, ts + INTERVAL 2 HOUR AS local_ts,
       strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS local_iso,
       CAST(ts + INTERVAL 2 HOUR AS DATE) AS local_date,
       CAST(hour(ts + INTERVAL 2 HOUR) AS INTEGER) AS local_hour,
       ts AS back_to_utc
FROM events""")
def local_time_convert(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    local = S.utc_to_local("ts", TZ)
    return ev.select("event_id", "ts", local.alias("local_ts"),
                     S.iso_local("ts", TZ).alias("local_iso"),
                     F.to_date(local).alias("local_date"), F.hour(local).alias("local_hour"),
                     S.local_to_utc(local, TZ).alias("back_to_utc"))


@register("truncate_hour", """
SELECT event_id, ts, date_trunc('hour', ts) AS hour_start FROM events""")
def truncate_hour(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", S.truncate_hour("ts").alias("hour_start"))


@register("json_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_props(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", S.json_fields("props", "k INT").getField("k").alias("k"))


# Messy landed names and what sanitising must turn them into.
MESSY_PART_COLUMNS = {
    "p_partkey": "Part Key",
    "p_name": "partName",
    "p_brand": "Brand.Code",
    "p_type": "Type (Full)",
    "p_size": "Size-CM",
    "p_retailprice": "Retail Price €",
}


@register("sanitize_columns", """
SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand_code,
       p_type AS type_full, p_size AS size_cm, p_retailprice AS retail_price
FROM part""")
def sanitize_columns(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    messy = part.select([F.col(c).alias(m) for c, m in MESSY_PART_COLUMNS.items()])
    return messy.toDF(*[S.sanitize_name(c) for c in messy.columns])
