"""Explicit schemas for every raw source (no inference outside landing)."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import DAILY_WEATHER_PARAMS, HOURLY_WEATHER_PARAMS

CORRUPT_COLUMN = "_corrupt_record"

FILMS_RAW = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("rating", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("studio", T.StringType()),
    T.StructField("budget", T.DoubleType()),
    T.StructField("box_office", T.DoubleType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField(CORRUPT_COLUMN, T.StringType()),
])

_display = T.StructType([T.StructField("display_name", T.StringType())])

POSTING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("redirect_url", T.StringType()),
    T.StructField("created", T.StringType()),
    T.StructField("location", _display),
    T.StructField("company", _display),
    T.StructField("category", T.StructType([T.StructField("label", T.StringType())])),
])

JOB_PAGE = T.StructType([
    T.StructField("results", T.ArrayType(POSTING)),
    T.StructField(CORRUPT_COLUMN, T.StringType()),
])

PIPELINE_STATE = T.StructType([
    T.StructField("state_id", T.StringType(), False),
    T.StructField("version", T.LongType(), False),
    T.StructField("last_extraction_time", T.TimestampNTZType()),
    T.StructField("total_jobs_extracted", T.LongType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])


def _series_struct(time_field: str, params: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(time_field, T.ArrayType(T.StringType()))]
        + [T.StructField(p, T.ArrayType(T.DoubleType())) for p in params]
    )


DAILY_RESPONSE = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("daily", _series_struct("time", DAILY_WEATHER_PARAMS)),
])

HOURLY_RESPONSE = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("hourly", _series_struct("time", HOURLY_WEATHER_PARAMS)),
])

LOCATION = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

DAILY_WEATHER = T.StructType([T.StructField(p, T.DoubleType()) for p in DAILY_WEATHER_PARAMS])
HOURLY_WEATHER = T.StructType([T.StructField(p, T.DoubleType()) for p in HOURLY_WEATHER_PARAMS])

DAILY_METADATA = T.StructType([
    T.StructField("data_source", T.StringType()),
    T.StructField("api_version", T.StringType()),
    T.StructField("collected_at", T.TimestampNTZType()),
])

# The partitioned daily tree as written by the daily sink (S6 reader schema).
DAILY_RECORD = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("location", LOCATION),
    T.StructField("weather", DAILY_WEATHER),
    T.StructField("metadata", DAILY_METADATA),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])
