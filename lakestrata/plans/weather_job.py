"""Weather jobs: the daily archive load (C9, C10) and the hourly pick.

All months / all responses are one Spark job: months are partitions, not
loop turns, and the load report compares the calendar with the rows that this
run wrote.  Stored records are keyed by site and time: a run replaces
its own records and leaves those of other sites alone.  Malformed responses
and days without a date are kept apart and counted, never lost.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import WeatherConfig
from ..operators import weather as W
from ..session import checkpoint_root, ensure_utc
from ..sources import raw_json, tables


def _quarantine(rows: DataFrame, out_path: str, run_ts: dt.datetime, reason: str) -> int:
    """Append what a run could not use, as JSON text, beside its output; the number of rows."""
    obs = Observation(f"quarantine_{reason}")
    kept = rows.select(F.to_json(F.struct(*rows.columns)).alias("record")).withColumns(
        {"reason": F.lit(reason), "run_ts": F.lit(run_ts.isoformat())}).observe(obs, F.count(F.lit(1)).alias("n"))
    kept.write.mode("append").json(quarantine_path(out_path))
    return int(obs.get.get("n") or 0)


def quarantine_path(out_path: str) -> str:
    return f"{out_path.rstrip('/')}_quarantine"


def run_weather_daily(spark: SparkSession, responses_path: str, out_path: str,
                      run_ts: dt.datetime, cfg: WeatherConfig = WeatherConfig(),
                      keep: list[str] | None = None, extra_fields=None,
                      multi_line: bool = True, request_year: str | None = None,
                      request_month: str | None = None, ledger: str | None = None) -> DataFrame:
    """Landed daily responses -> daily records of the calendar's months
    (future days dropped) -> records of the same site and day replaced -> load
    report, with the counts of quarantined responses and rejected days.

    ``keep`` columns (declared by ``extra_fields``, e.g. a site id) ride
    along into the stored records and are part of their key.
    ``request_year`` / ``request_month`` (P11) name the fields that carry the request.
    ``ledger`` names a table that gets one row for each month of the run, with its outcome
    (``weather.month_outcomes``), after the records are stored; ``weather.month_history`` reads it."""
    ensure_utc(spark)
    keep = list(keep or [])
    cal = W.calendar_back(spark, run_ts, cfg.years_back)
    landed = raw_json.read_weather_responses(spark, responses_path, multi_line=multi_line, extra_fields=extra_fields)
    resp, broken = raw_json.split_corrupt(landed)
    rows = W.weather_daily(resp, run_ts, keep=keep, location=W.site_struct(cfg.site),
                           request_year=request_year, request_month=request_month)
    n_broken = _quarantine(broken, out_path, run_ts, "malformed")
    n_undated = _quarantine(rows.where(F.col("date").isNull()), out_path, run_ts, "undated")
    rows = rows.where(F.col("date") <= F.lit(run_ts.date()))
    rows = rows.join(cal.select("year", "month"), ["year", "month"], "left_semi").select(*rows.columns)
    checkpoint_root(spark)
    rows = rows.checkpoint()
    tables.merge_partitions(rows, out_path, ["year", "month"], [*keep, "location", "date"],
                            fmt=cfg.table_format)
    if ledger:
        arrivals = W.month_arrivals(landed, run_ts, raw_json.CORRUPT_COLUMN, request_year=request_year,
                                    request_month=request_month)
        tables.write_table(W.month_outcomes(cal, arrivals, run_ts), ledger, mode="append", fmt=cfg.table_format)
    written = rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))
    return W.month_load_report(cal, written).withColumns(
        {"quarantined": F.lit(n_broken), "rejected_days": F.lit(n_undated)})


def run_weather_hourly(spark: SparkSession, responses_path: str, out_path: str,
                       run_ts: dt.datetime, cfg: WeatherConfig = WeatherConfig(),
                       keep: list[str] | None = None, extra_fields=None,
                       multi_line: bool = True) -> dict:
    """Landed hourly responses -> one pick per response -> the record of
    that site and hour replaced.  Returns a receipt."""
    ensure_utc(spark)
    keep = list(keep or [])
    resp, broken = raw_json.split_corrupt(raw_json.read_weather_responses(
        spark, responses_path, hourly=True, multi_line=multi_line, extra_fields=extra_fields))
    n_broken = _quarantine(broken, out_path, run_ts, "malformed")
    picks = W.nearest_hour(resp, run_ts, keep=keep, zone=cfg.local_timezone,
                           location=W.site_struct(cfg.site))
    obs = Observation("hourly_load")
    picks = W.hour_partition_columns(picks).observe(
        obs, F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"))
    # zero rows touch no partition: an empty run writes nothing
    tables.merge_partitions(picks, out_path, ["year", "month", "day", "hour"], [*keep, "location"],
                            fmt=cfg.table_format)
    m = obs.get
    n = int(m.get("n") or 0)
    return {"success": n > 0, "data_collected": n > 0, "records": n, "quarantined": n_broken,
            "first_timestamp": m.get("first"), "last_timestamp": m.get("last")}
