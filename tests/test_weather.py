"""Weather flow on hand-written responses (FIXTURES §4, §5) and brute-force checks."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.config import DAILY_WEATHER_PARAMS, HOURLY_WEATHER_PARAMS, WeatherConfig
from lakestrata.functions.scalars import ts_lit
from lakestrata.operators import weather as W
from lakestrata.plans.weather_job import run_weather_daily, run_weather_hourly
from lakestrata.session import local_fs_path, scratch_path
from lakestrata.sources import raw_json


def write(base, name, obj):
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/{name}.json", "w") as f:
        json.dump(obj, f, indent=2)       # pretty-printed, as the collectors wrote


def days(year, month, n):
    return [f"{year}-{month:02d}-{d:02d}" for d in range(1, n + 1)]


@pytest.fixture(scope="module")
def daily_dir(spark):
    base = local_fs_path(scratch_path(spark, "daily_fixture"))
    jan = {p: [float(i) for i in range(31)] for p in DAILY_WEATHER_PARAMS}
    jan["time"] = days(2024, 1, 31)
    jan["rain_sum"][3] = None                                   # null element
    write(base, "jan", {"latitude": -25.4753, "daily": jan})
    feb = {p: [float(i) for i in range(29)] for p in DAILY_WEATHER_PARAMS if p != "et0_fao_evapotranspiration"}
    feb["time"] = days(2024, 2, 29)                             # leap February
    feb["snowfall_sum"] = feb["snowfall_sum"][:28]               # one short
    feb["uv_index_max"] = [9.0] * 29                             # not requested
    write(base, "feb", {"daily": feb})                           # et0 absent
    write(base, "nodaily", {"latitude": 1.0})
    write(base, "notime", {"daily": {"time": []}})
    return base


def test_daily_rows(spark, daily_dir):
    resp = raw_json.read_weather_responses(spark, daily_dir)
    rows = W.weather_daily(resp, dt.datetime(2024, 3, 1)).cache()
    assert rows.count() == 60
    feb29 = rows.where(F.col("date") == F.lit(dt.date(2024, 2, 29))).first()
    assert feb29 is not None and feb29["month"] == 2 and feb29["year"] == 2024
    assert feb29["weather"]["snowfall_sum"] is None                     # short series padded
    assert feb29["weather"]["et0_fao_evapotranspiration"] is None       # absent series
    assert feb29["weather"]["rain_sum"] == 28.0
    jan4 = rows.where(F.col("date") == F.lit(dt.date(2024, 1, 4))).first()
    assert jan4["weather"]["rain_sum"] is None and jan4["weather"]["temperature_2m_max"] == 3.0
    assert "uv_index_max" not in rows.schema["weather"].dataType.fieldNames()
    assert jan4["location"]["name"].startswith("Nelspruit")
    assert jan4["metadata"]["data_source"] == "open_meteo_historical"


def test_zip_roundtrip_identity(spark):
    rnd = random.Random(3)
    rows = [(g, t, rnd.random(), rnd.choice([None, 1.5, 2.5])) for g in range(20) for t in range(rnd.randint(1, 30))]
    df = spark.createDataFrame(rows, "g int, t int, a double, b double")
    z = W.zip_series(df, ["g"], "t", ["a", "b"])
    back = W.unzip_series(z, "series", ["a", "b"], keep=["g"]).select("g", F.col("time").alias("t"), "a", "b")
    assert sorted(map(tuple, back.collect())) == sorted(rows, key=lambda r: (r[0], r[1]))


def test_daily_job_report(spark, daily_dir):
    out = local_fs_path(scratch_path(spark, "daily_out"))
    cfg = WeatherConfig(years_back=1)
    report = run_weather_daily(spark, daily_dir, out, dt.datetime(2024, 2, 15, 8), cfg).first()
    assert report["success_months"] == "2024-01,2024-02"
    assert report["total_months_processed"] == 13
    assert report["failed_months"].split(",")[0] == "2023-02"
    stored = spark.read.parquet(out)
    assert stored.count() == 31 + 15                    # future days of February dropped
    # re-run: the same months are replaced, not appended
    run_weather_daily(spark, daily_dir, out, dt.datetime(2024, 2, 15, 8), cfg)
    assert spark.read.parquet(out).count() == 31 + 15


def hours(start: dt.datetime, n: int, fmt="%Y-%m-%dT%H:%M"):
    return [(start + dt.timedelta(hours=i)).strftime(fmt) for i in range(n)]


def hourly(times, **over):
    h = {p: [float(i) for i in range(len(times))] for p in HOURLY_WEATHER_PARAMS}
    h["time"] = times
    h.update(over)
    return {"hourly": h}


RUN = dt.datetime(2024, 1, 15, 10, 20)     # 12:20 local -> anchor 12:00 local


@pytest.fixture(scope="module")
def hourly_dir(spark):
    base = local_fs_path(scratch_path(spark, "hourly_fixture"))
    day0 = dt.datetime(2024, 1, 14)
    write(base, "r1_exact", hourly(hours(day0, 48)))
    gap = [t for t in hours(day0, 48) if not ("2024-01-15T10" <= t <= "2024-01-15T12:59")]
    write(base, "r2_gap", hourly(gap))
    write(base, "r3_future", hourly(hours(dt.datetime(2024, 1, 15, 13), 11)))
    write(base, "r4_dup", hourly(["2024-01-15T11:00", "2024-01-15T12:00", "2024-01-15T13:00", "2024-01-15T12:00"]))
    write(base, "r5_unsorted", hourly(["2024-01-15T14:00", "2024-01-15T11:00", "2024-01-15T12:00", "2024-01-15T10:00"]))
    write(base, "r6_offset", hourly(["2024-01-15T09:00:00Z", "2024-01-15T10:00:00+00:00", "2024-01-15T13:00:00+02:00"]))
    write(base, "r7_short", hourly(hours(day0, 48), visibility=[1.0]))
    write(base, "r8_nohourly", {"latitude": 1.0})
    write(base, "r9_notime", {"hourly": {"time": []}})
    return base


def test_nearest_hour_rules(spark, hourly_dir):
    resp = raw_json.read_weather_responses(spark, hourly_dir, hourly=True)
    picks = {os.path.basename(r["response_id"]).split(".")[0]: r
             for r in W.nearest_hour(resp, RUN, keep=["response_id"]).collect()}
    assert set(picks) == {"r1_exact", "r2_gap", "r3_future", "r4_dup", "r5_unsorted", "r6_offset", "r7_short"}
    assert picks["r1_exact"]["timestamp"] == "2024-01-15T12:00:00+02:00"
    assert picks["r1_exact"]["weather"]["temperature_2m"] == 36.0
    assert picks["r2_gap"]["timestamp"] == "2024-01-15T09:00:00+02:00"
    assert picks["r3_future"]["timestamp"] == "2024-01-15T13:00:00+02:00"
    assert picks["r4_dup"]["weather"]["temperature_2m"] == 1.0          # first of the duplicates
    assert picks["r5_unsorted"]["timestamp"] == "2024-01-15T12:00:00+02:00"
    assert picks["r6_offset"]["timestamp"] == "2024-01-15T12:00:00+02:00"   # 10:00Z
    assert picks["r7_short"]["weather"]["visibility"] is None            # series too short
    r = picks["r1_exact"]
    assert (r["date"], r["hour"], r["year"], r["month"], r["day"]) == (dt.date(2024, 1, 15), 12, 2024, 1, 15)
    assert r["metadata"]["local_timezone"] == "Africa/Johannesburg"


def test_anchor_after_local_midnight(spark):
    base = local_fs_path(scratch_path(spark, "midnight_fixture"))
    write(base, "two_days", hourly(hours(dt.datetime(2024, 1, 15), 48)))
    resp = raw_json.read_weather_responses(spark, base, hourly=True)
    late = dt.datetime(2024, 1, 15, 22, 5)    # 00:05 on the 16th, local
    r = W.nearest_hour(resp, late).first()
    assert r["timestamp"] == "2024-01-16T00:00:00+02:00"
    assert (r["date"], r["hour"], r["day"]) == (dt.date(2024, 1, 16), 0, 16)


def test_hourly_job_partitions(spark, hourly_dir):
    out = local_fs_path(scratch_path(spark, "hourly_out"))
    receipt = run_weather_hourly(spark, f"{hourly_dir}/r1_exact.json", out, RUN)
    assert receipt["success"] and receipt["records"] == 1
    assert os.path.isdir(f"{out}/year=2024/month=01/day=15/hour=12")
    run_weather_hourly(spark, f"{hourly_dir}/r1_exact.json", out, RUN)   # same hour replaced
    assert spark.read.parquet(out).count() == 1


def _brute_nearest(times, anchor):
    best = None
    for i, t in enumerate(times):
        key = (t <= anchor, -abs((t - anchor).total_seconds()), -i)
        if best is None or key > best[0]:
            best = (key, i)
    return None if best is None else best[1]


def test_nearest_index_matches_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 15)
    cases = []
    for c in range(300):
        n = rnd.randint(1, 12)
        times = [base + dt.timedelta(hours=rnd.randint(-6, 6)) for _ in range(n)]
        cases.append((c, [t.strftime("%Y-%m-%dT%H:%M") for t in times], times))
    df = spark.createDataFrame([(c, s) for c, s, _ in cases], "c int, t array<string>")
    anchor_local = base + dt.timedelta(hours=0)
    anchor = W.local_to_utc(ts_lit(anchor_local), "Africa/Johannesburg")
    got = {r["c"]: r["i"] for r in df.select("c", W.nearest_index(F.col("t"), anchor, "Africa/Johannesburg")
                                                .alias("i")).collect()}
    for c, _, times in cases:
        assert got[c] == _brute_nearest(times, anchor_local), (c, times)
        i = got[c]
        if any(t <= anchor_local for t in times):
            assert times[i] <= anchor_local          # never after the anchor if a past hour exists


@pytest.mark.parametrize("mode", ["time", "range"])
def test_asof_backward_matches_brute_force(spark, mode):
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    events = []
    for e in range(1500):
        user = 0 if e % 3 == 0 else rnd.randint(1, 30)       # user 0 holds a third of the rows
        span = 3600 if user == 0 else 10 * 86400              # ... packed into one hour
        events.append((user, t0 + dt.timedelta(seconds=rnd.randint(0, span)), e))
    anchors = [(rnd.randint(0, 32), t0 + dt.timedelta(seconds=rnd.randint(-86400, 12 * 86400)))
               for _ in range(400)]
    anchors += [(0, t0 + dt.timedelta(seconds=rnd.randint(-60, 3700))) for _ in range(100)]
    anchors = list(dict.fromkeys(anchors))
    ev = spark.createDataFrame(events, "user long, ts timestamp_ntz, event_id long")
    an = spark.createDataFrame(anchors, "user long, at timestamp_ntz")
    got = {(r["user"], r["at"]): r["event_id"]
           for r in W.asof_backward(an, ev, ["user"], "at", "ts", bucket_seconds=6 * 3600,
                                    partitioning=mode, num_ranges=16).collect()}
    want = {}
    for u, at in anchors:
        cands = [(ts, e) for uu, ts, e in events if uu == u and ts <= at]
        if cands:
            want[(u, at)] = max(cands)[1]
    assert got == want


def test_request_month_labels_rows(spark):
    """A response for January that also holds Feb 1 labels it January."""
    base = local_fs_path(scratch_path(spark, "request_month_fixture"))
    d = {p: [1.0, 2.0] for p in DAILY_WEATHER_PARAMS}
    d["time"] = ["2024-01-31", "2024-02-01"]
    write(base, "r", {"daily": d, "req_year": 2024, "req_month": 1})
    from pyspark.sql import types as T
    resp = raw_json.read_weather_responses(
        spark, base, extra_fields=[T.StructField("req_year", T.IntegerType()),
                                   T.StructField("req_month", T.IntegerType())])
    by_request = {str(r["date"]): r["month"] for r in W.weather_daily(
        resp, RUN, request_year="req_year", request_month="req_month").collect()}
    by_date = {str(r["date"]): r["month"] for r in W.weather_daily(resp, RUN).collect()}
    assert by_request == {"2024-01-31": 1, "2024-02-01": 1}
    assert by_date == {"2024-01-31": 1, "2024-02-01": 2}
