"""Ledger of months: one outcome a run and month, the history over runs."""

import datetime as dt
import json

from pyspark.sql import types as T

from lakestrata.config import WeatherConfig
from lakestrata.operators import weather as W
from lakestrata.plans.jobs_queries import scratch_database
from lakestrata.plans.weather_job import run_weather_daily
from lakestrata.session import scratch_path

RUN1, RUN2 = dt.datetime(2024, 6, 10, 8), dt.datetime(2024, 6, 20, 8)


def land(spark, *lines):
    path = scratch_path(spark, "month_landing")
    spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string").write.text(path)
    return path


def response(*times):
    return {"daily": {"time": list(times), "temperature_2m_max": [1.0] * len(times)}}


def test_every_outcome_is_told_and_the_history_keeps_the_load(spark):
    out, ledger = scratch_path(spark, "month_out"), f"{scratch_database(spark, 't_months')}.months"
    cfg = WeatherConfig(years_back=1)
    first = land(spark, response("2024-01-01", "2024-01-02", None),                      # loaded, one day undated
                 '{"daily": {"time": ["2024-02-01", "2024-02-0',                          # malformed, its month told
                 response("2024-06-30"),                                                  # only after the run
                 response("2022-01-05"),                                                  # outside the calendar
                 response("n/a"), "not json at all", {"daily": None})
    run_weather_daily(spark, first, out, RUN1, cfg, multi_line=False, ledger=ledger)
    rows = {(r.year, r.month): r for r in spark.table(ledger).collect()}
    told = {k: r.outcome for k, r in rows.items() if r.outcome != W.MISSING}
    assert told == {(2024, 1): W.LOADED, (2024, 2): W.QUARANTINED, (2024, 6): W.EMPTY, (2022, 1): W.OUTSIDE,
                    (None, None): W.UNKNOWN}
    assert len(rows) == 13 + 2 and rows[2024, 1].days_in_time == 2 and rows[2024, 6].days_future == 1
    lost = rows[None, None]
    assert (lost.responses, lost.malformed, lost.days_undated) == (2, 1, 2)               # every row is counted somewhere

    again = land(spark, response("2024-02-01", "2024-02-02"))
    for _ in range(2):                                                                    # the second run is repeated
        run_weather_daily(spark, again, out, RUN2, cfg, multi_line=False, ledger=ledger)
    history = {(r.year, r.month): r for r in W.month_history(spark.table(ledger)).collect()}
    assert {k: (r.state, r.runs) for k, r in history.items() if r.state != W.MISSING} == {
        (2024, 1): (W.LOADED, 2), (2024, 2): (W.LOADED, 2), (2022, 1): (W.OUTSIDE, 1), (None, None): (W.UNKNOWN, 1)}
    assert history[2024, 1].last_outcome == W.MISSING and history[2024, 1].days_loaded == 2
    assert history[2024, 2].malformed == 1 and history[2024, 2].loaded_runs == 1
    assert spark.read.parquet(out).count() == 4


def test_the_requested_month_counts_before_the_dates(spark):
    path = land(spark, {"y": 2024, "m": 3, **response("2024-04-01", "x")}, '{"y": 2024, "m": "5", "daily": {"time": ["2024-01-')
    schema = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("m", T.IntegerType())])
    from lakestrata.sources import raw_json
    landed = raw_json.read_weather_responses(spark, path, multi_line=False, extra_fields=schema.fields)
    got = W.month_arrivals(landed, RUN1, raw_json.CORRUPT_COLUMN, request_year="y", request_month="m").collect()
    assert {(r.year, r.month): (r.responses, r.malformed, r.days_in_time, r.days_undated) for r in got} == {
        (2024, 3): (1, 0, 1, 1), (2024, 5): (0, 1, 0, 0)}


def test_an_empty_landing_leaves_the_calendar_missing(spark):
    from lakestrata.sources import raw_json
    landed = raw_json.read_weather_responses(spark, land(spark), multi_line=False)
    rows = W.month_outcomes(W.calendar_back(spark, RUN1, 1), W.month_arrivals(landed, RUN1, raw_json.CORRUPT_COLUMN), RUN1).collect()
    assert len(rows) == 13 and {r.outcome for r in rows} == {W.MISSING}
    assert sum(r.responses + r.malformed for r in rows) == 0


def test_the_registered_query_meets_every_outcome(spark, smoke_dir):
    import __spark_entry__ as E
    rows = E.queries()["weather_month_outcomes"](spark, smoke_dir).collect()
    assert {r.state for r in rows} == {W.LOADED, W.QUARANTINED, W.EMPTY, W.MISSING, W.OUTSIDE}
    late = E.queries()["stream_jobs_watermark"](spark, smoke_dir).groupBy("outcome").count().collect()
    assert {r["outcome"] for r in late} == {"stored", "late"}
