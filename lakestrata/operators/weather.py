"""Weather: parallel-array responses -> rows (C8), nearest-hour pick (J2,
C11), as-of join for many anchors, month calendar (F5), load report (A8),
response profile (A9).

A response is one row holding a struct of parallel arrays.  Unpivoting and
the nearest-hour pick are per-row array expressions (``transform``,
``get``, ``array_max``): they run inside the scan's stage, with no shuffle,
whatever the number of responses.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import (DAILY_DATA_SOURCE, DAILY_WEATHER_PARAMS, DEFAULT_LOCAL_TIMEZONE,
                      HOURLY_DATA_SOURCE, HOURLY_WEATHER_PARAMS, WEATHER_API_VERSION,
                      WeatherSite)
from ..functions.scalars import (epoch_micros, iso_local, local_to_utc, month_label, ts_lit,
                                 utc_to_local)
from ..session import checkpoint_root

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def site_struct(site: WeatherSite = WeatherSite()) -> Column:
    """The location struct of a site (constants)."""
    return F.struct(F.lit(site.name).alias("name"), F.lit(site.latitude).alias("latitude"),
                    F.lit(site.longitude).alias("longitude"))


def series_elements(series: ColumnOrName, params: Sequence[str], time_field: str = "time") -> Column:
    """Array of structs ``(pos, time, <params>)``, one per element of
    ``series.time``.  A param array that is absent (null) or too short gives
    null values (never drops the row: D14); longer arrays and unrequested
    series are ignored (P12)."""
    s = _c(series)
    return F.transform(
        s.getField(time_field),
        lambda t, i: F.struct(i.alias("pos"), t.alias("time"),
                              *[F.get(s.getField(p), i).alias(p) for p in params]))


def unzip_series(df: DataFrame, series: str, params: Sequence[str], keep: Sequence[str] = (),
                 time_field: str = "time") -> DataFrame:
    """Parallel arrays -> one row per time point: ``keep`` columns, ``pos``,
    ``time`` and one column per param.  Responses without the series or with
    an empty ``time`` give no rows (F6)."""
    return df.select(*keep, F.inline(series_elements(series, params, time_field)))


def zip_series(df: DataFrame, group: Sequence[str], order: str, values: Sequence[str],
               out: str = "series") -> DataFrame:
    """The inverse: rows -> one row per ``group`` with a struct of parallel
    arrays ordered by ``order``.  Each group is collected, so ``group`` must
    bound its size (a response: one month of days, two days of hours)."""
    item = F.struct(F.col(order).alias("_o"), *[F.col(v) for v in values])
    g = df.groupBy(*group).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    return g.select(*group, F.struct(F.col("_items._o").alias("time"),
                                     *[F.col(f"_items.{v}").alias(v) for v in values]).alias(out))


def weather_daily(responses: DataFrame, run_ts: dt.datetime, keep: Sequence[str] = (),
                  location: Column | None = None, params: Sequence[str] = DAILY_WEATHER_PARAMS,
                  series: str = "daily", request_year: str | None = None,
                  request_month: str | None = None) -> DataFrame:
    """Daily responses -> one record per day: ``date``, ``location``,
    ``weather`` (the requested params), ``metadata``, and ``year``/``month``
    for partitioning.  ``run_ts`` is the collection time (one value per run).

    P11: ``year``/``month`` come from the request when the responses carry
    it (``request_year`` / ``request_month`` columns), else from the date;
    they differ only for a day outside the requested month."""
    carried = [c for c in (request_year, request_month) if c]
    rows = unzip_series(responses.withColumn("_loc", location if location is not None else site_struct()),
                        series, params, keep=[*keep, *carried, "_loc"])
    date = F.try_to_date(F.col("time"))
    year = F.col(request_year).cast("int") if request_year else F.year(date)
    month = F.col(request_month).cast("int") if request_month else F.month(date)
    return rows.select(
        *keep,
        date.alias("date"),
        F.col("_loc").alias("location"),
        F.struct(*[F.col(p) for p in params]).alias("weather"),
        F.struct(F.lit(DAILY_DATA_SOURCE).alias("data_source"),
                 F.lit(WEATHER_API_VERSION).alias("api_version"),
                 ts_lit(run_ts).alias("collected_at")).alias("metadata"),
        year.alias("year"),
        month.alias("month"),
    )


def parse_series_time(t: Column, zone: str) -> Column:
    """Series time text -> UTC wall clock.  Text with ``Z`` or an offset is an
    instant; zone-less text is local time in ``zone`` (the zone the request
    asked for -- not the host's, D8)."""
    zoned = t.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    return F.when(zoned, F.try_to_timestamp(t).cast("timestamp_ntz")) \
            .otherwise(local_to_utc(t.try_cast("timestamp_ntz"), zone))


def anchor_hour(run_ts: dt.datetime, zone: str) -> Column:
    """``run_ts`` (UTC) truncated to the hour *in local time*, back in UTC."""
    local = utc_to_local(ts_lit(run_ts), zone)
    return local_to_utc(F.date_trunc("hour", local).cast("timestamp_ntz"), zone)


def nearest_index(times: Column, anchor_utc: Column, zone: str) -> Column:
    """J2 on one response: index of the latest time at or before the anchor;
    if every time is after it, the earliest one; ties -> first index.
    Unparseable times are never chosen.  Null when nothing qualifies."""
    def key(t, i):
        ts = parse_series_time(t, zone)
        diff = F.abs(F.timestamp_diff("SECOND", ts, anchor_utc))
        return F.when(ts.isNotNull(),
                      F.struct((ts <= anchor_utc).alias("past"), (-diff).alias("closeness"),
                               (-i).alias("neg_pos"), i.alias("pos")))
    return F.array_max(F.transform(times, key)).getField("pos")


def nearest_hour(responses: DataFrame, run_ts: dt.datetime, keep: Sequence[str] = (),
                 zone: str = DEFAULT_LOCAL_TIMEZONE, location: Column | None = None,
                 params: Sequence[str] = HOURLY_WEATHER_PARAMS, series: str = "hourly") -> DataFrame:
    """C11: one record per response -- the hour nearest ``run_ts`` (J2) with
    ``timestamp`` (local ISO with offset), ``date``, ``hour``, ``location``,
    ``weather``, ``metadata`` and ``year``/``month``/``day`` (local).
    Responses with no usable time give no row."""
    s = F.col(series)
    anchor = anchor_hour(run_ts, zone)
    picked = responses.select(
        *keep, (location if location is not None else site_struct()).alias("location"), s.alias("_s"),
        nearest_index(s.getField("time"), anchor, zone).alias("_i")).where(F.col("_i").isNotNull())
    t_utc = parse_series_time(F.get(F.col("_s.time"), F.col("_i")), zone)
    local = utc_to_local(t_utc, zone)
    return picked.select(
        *keep,
        iso_local(t_utc, zone).alias("timestamp"),
        F.to_date(local).alias("date"),
        F.hour(local).alias("hour"),
        "location",
        F.struct(*[F.get(F.col(f"_s.{p}"), F.col("_i")).alias(p) for p in params]).alias("weather"),
        F.struct(F.lit(HOURLY_DATA_SOURCE).alias("data_source"),
                 F.lit(WEATHER_API_VERSION).alias("api_version"),
                 ts_lit(run_ts).alias("collected_at"),
                 F.lit(zone).alias("local_timezone")).alias("metadata"),
        F.year(local).alias("year"), F.month(local).alias("month"),
        F.dayofmonth(local).alias("day"),
    )


def hour_partition_columns(df: DataFrame) -> DataFrame:
    """K3 layout: zero-padded string partitions ``year/month/day/hour`` (so
    ``month=01`` on disk); the int ``hour`` field becomes the partition."""
    pad = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")
    return (df.withColumn("year", F.col("year").cast("string"))
              .withColumn("month", pad("month")).withColumn("day", pad("day"))
              .withColumn("hour", pad("hour")))


def response_profile(responses: DataFrame, keep: Sequence[str] = (), series: str = "hourly") -> DataFrame:
    """Number of time points, first and last time of each response (null
    times where there are no points)."""
    t = F.col(f"{series}.time")
    return responses.select(*keep, F.size(t).alias("n_points"),
                            F.try_element_at(t, F.lit(1)).alias("first_time"),
                            F.try_element_at(t, F.lit(-1)).alias("last_time"))


# ---------------------------------------------------------------------------
# As-of join for many anchors
# ---------------------------------------------------------------------------

def asof_backward(anchors: DataFrame, events: DataFrame, by: Sequence[str], anchor_ts: str,
                  event_ts: str, bucket_seconds: int = 86400, partitioning: str = "time",
                  num_ranges: int | None = None, forward: bool = False) -> DataFrame:
    """For each anchor row, the latest event with the same ``by`` keys and
    ``event_ts <= anchor_ts`` (inner: anchors without one are dropped, unless ``forward``:
    they get the earliest event after them, and only keys without events go).

    ``forward``: a second running pass over the same shuffled rows in the other
    direction, and a second carry over the buckets' first events.

    No pairs are formed.  Anchors and events are tagged and sorted together
    within (``by``, bucket): a running ``last`` finds in-bucket matches.
    Anchors left over take the last event of the nearest earlier non-empty
    bucket of their key, found by the same running ``last`` over one summary
    row per (``by``, bucket).

    Buckets: ``partitioning="time"`` cuts time into ``bucket_seconds``
    slices (one shuffle by key and slice; a hot key spreads over its
    slices).  ``partitioning="range"`` takes the buckets from
    ``repartitionByRange`` on (``by``, time): the boundaries come from a
    sample of the data, so even a key that is dense inside one short span is
    split over many partitions, each about ``rows / num_ranges`` rows.
    Summary rows per key are at most the number of buckets.
    Event payload columns are all event columns except ``by``.  Rows with a
    null key or time match nothing; of events at one time the greatest payload
    (by its columns in order) is taken.
    """
    by = list(by)
    for c in by:
        anchors, events = anchors.where(F.col(c).isNotNull()), events.where(F.col(c).isNotNull())
    anchors, events = anchors.where(F.col(anchor_ts).isNotNull()), events.where(F.col(event_ts).isNotNull())
    payload_cols = [c for c in events.columns if c not in by]
    payload = F.struct(*[F.col(c) for c in payload_cols])

    def bucket(c: str) -> Column:
        dtype = (anchors if c == anchor_ts else events).schema[c].dataType
        micros = epoch_micros(c, ntz=isinstance(dtype, T.TimestampNTZType))
        return F.floor(micros / (bucket_seconds * 1_000_000))

    time_mode = partitioning == "time"
    ev = events.select(*by, F.col(event_ts).alias("_t"),
                       (bucket(event_ts) if time_mode else F.lit(0).cast("long")).alias("_b"),
                       F.lit(0).alias("_kind"), payload.alias("_ev"),
                       F.lit(None).cast(anchors.schema[anchor_ts].dataType).alias("_anchor"))
    an = anchors.select(*by, F.col(anchor_ts).alias("_t"),
                        (bucket(anchor_ts) if time_mode else F.lit(0).cast("long")).alias("_b"),
                        F.lit(1).alias("_kind"), F.lit(None).cast(ev.schema["_ev"].dataType).alias("_ev"),
                        F.col(anchor_ts).alias("_anchor"))
    both = ev.unionByName(an)
    if not time_mode:
        n = num_ranges or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        both = (both.repartitionByRange(n, *[F.col(c) for c in by], F.col("_t"), F.col("_kind"))
                .withColumn("_b", F.spark_partition_id().cast("long")))
        # the bucket id comes from sampled boundaries: materialise it once
        # (reliable checkpoint in the shared folder) so every branch below
        # sees the same buckets, also after a recomputation
        checkpoint_root(both.sparkSession)
        both = both.checkpoint(eager=True)
        ev = both.where(F.col("_kind") == 0)
    w = (Window.partitionBy(*by, "_b").orderBy("_t", "_kind", "_ev")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    tagged = both.withColumn("_m", F.last("_ev", ignorenulls=True).over(w))
    if forward:
        # of events at one time the greatest payload comes last here too
        back = (Window.partitionBy(*by, "_b").orderBy(F.col("_t").desc(), F.col("_kind").desc(), "_ev")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        tagged = tagged.withColumn("_n", F.last("_ev", ignorenulls=True).over(back))
    else:
        tagged = tagged.withColumn("_n", F.lit(None).cast(both.schema["_ev"].dataType))
    anchors_out = tagged.where(F.col("_kind") == 1)
    resolved = anchors_out.where(F.col("_m").isNotNull())
    pending = anchors_out.where(F.col("_m").isNull()).select(*by, "_b", "_anchor", "_n")

    # one row per (by, bucket) with events: the bucket's last event, and its first
    ntz = isinstance(both.schema["_t"].dataType, T.TimestampNTZType)
    ends = ev.groupBy(*by, "_b").agg(
        F.max_by("_ev", F.struct("_t", "_ev")).alias("_last"),
        F.max_by("_ev", F.struct((-epoch_micros("_t", ntz=ntz)).alias("t"), "_ev")).alias("_first"))
    need = pending.select(*by, "_b").distinct()
    carry = (ends.withColumn("_need", F.lit(False))
             .unionByName(need.withColumn("_need", F.lit(True)), allowMissingColumns=True))

    def carried(column: str, order: Column) -> Column:
        # within a bucket the "need" row sorts first, so it only sees the buckets before it in this direction
        over = (Window.partitionBy(*by).orderBy(order, F.col("_need").desc())
                .rowsBetween(Window.unboundedPreceding, -1))
        return F.last(column, ignorenulls=True).over(over)

    carry = carry.withColumn("_prev", carried("_last", F.col("_b").asc()))
    carry = carry.withColumn("_next", carried("_first", F.col("_b").desc()) if forward
                             else F.lit(None).cast(both.schema["_ev"].dataType))
    carry = carry.where("_need").select(*by, "_b", "_prev", "_next")
    fallback = (pending.join(carry, [*by, "_b"])
                .select(*by, "_anchor", F.coalesce("_prev", "_n", "_next").alias("_m")).where(F.col("_m").isNotNull()))
    out = resolved.select(*by, "_anchor", "_m").unionByName(fallback)
    return out.select(*by, F.col("_anchor").alias(anchor_ts),
                      *[F.col(f"_m.{c}").alias(c) for c in payload_cols])


# ---------------------------------------------------------------------------
# Month calendar and load report
# ---------------------------------------------------------------------------

def month_calendar(bounds: DataFrame, start: str, end: str, run_ts: dt.datetime | None = None) -> DataFrame:
    """one row per month from ``start``'s month to ``end``'s month (both
    ends) for each row of ``bounds``; months starting after ``run_ts`` are
    skipped and the current month's end is clipped to ``run_ts``'s date."""
    months = bounds.select(F.explode(F.sequence(
        F.trunc(F.to_date(F.col(start)), "MM"), F.trunc(F.to_date(F.col(end)), "MM"),
        F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    month_end = F.last_day("month_start")
    if run_ts is not None:
        today = F.lit(run_ts.date())
        months = months.where(F.col("month_start") <= today)
        month_end = F.least(month_end, today)
    return months.select("month_start", month_end.alias("month_end"),
                         month_label("month_start").alias("month_label"),
                         F.year("month_start").alias("year"), F.month("month_start").alias("month"))


def calendar_back(spark, run_ts: dt.datetime, years_back: int) -> DataFrame:
    """C10's calendar: ``12*years_back + 1`` months ending at ``run_ts``'s month."""
    start = dt.date(run_ts.year - years_back, run_ts.month, 1)
    b = spark.range(1).select(F.lit(start).alias("s"), F.lit(run_ts.date()).alias("e"))
    return month_calendar(b, "s", "e", run_ts)


def month_load_report(calendar: DataFrame, loaded: DataFrame) -> DataFrame:
    """Months of ``calendar`` with rows in ``loaded`` (year, month, rows)
    succeeded; the others failed.  Lists are sorted month labels; the
    collected set is bounded by the calendar length."""
    j = calendar.join(loaded.where(F.col("rows") > 0).select("year", "month", F.lit(True).alias("_ok")),
                      ["year", "month"], "left")
    ok = F.col("_ok").isNotNull()
    return j.agg(
        F.array_join(F.array_sort(F.collect_list(F.when(ok, F.col("month_label")))), ",").alias("success_months"),
        F.array_join(F.array_sort(F.collect_list(F.when(~ok, F.col("month_label")))), ",").alias("failed_months"),
        F.count(F.lit(1)).alias("total_months_processed"),
    )


# ---------------------------------------------------------------------------
# Outcome of every month of every run
# ---------------------------------------------------------------------------

LOADED, QUARANTINED, EMPTY, MISSING, OUTSIDE, UNKNOWN = "loaded", "quarantined", "empty", "missing", "outside", "unknown"
ARRIVED = ("responses", "malformed", "days_in_time", "days_undated", "days_future")


def month_arrivals(responses: DataFrame, run_ts: dt.datetime, corrupt_column: str, series: str = "daily",
                   request_year: str | None = None, request_month: str | None = None) -> DataFrame:
    """Per (year, month) what a landing holds: well-formed and malformed responses, and the
    days of the former up to the run, undated or after it.

    A response belongs to the month that it was requested for, else to that of its first
    date; a malformed one to the month that its text still names.  Nothing to tell a month by: null.
    One pass that reads the time series only.
    """
    text, times = F.col(corrupt_column), F.col(series).getField("time")
    bad = text.isNotNull()

    def asked(name: str | None) -> Column:
        if not name:
            return F.lit(None).cast("int")
        said = F.regexp_extract(text, f'"{name}"\\s*:\\s*"?(\\d+)', 1)
        return F.coalesce(F.col(name).cast("int"), said.try_cast("int"))

    year, month = asked(request_year), asked(request_month)
    first = F.coalesce(F.array_min(F.transform(times, lambda t: F.try_to_date(t))),
                       F.try_to_date(F.regexp_extract(text, r"(\d{4}-\d{2}-\d{2})", 1)))
    whole = F.struct(F.coalesce(year, F.year(first)).alias("year"), F.coalesce(month, F.month(first)).alias("month"),
                     F.when(bad, "malformed").otherwise("responses").alias("kind"))

    def day(t: Column) -> Column:
        date = F.try_to_date(t)
        kind = (F.when(date.isNull(), "days_undated").when(date > F.lit(run_ts.date()), "days_future")
                .otherwise("days_in_time"))
        return F.struct(F.coalesce(year, F.year(date)).alias("year"), F.coalesce(month, F.month(date)).alias("month"),
                        kind.alias("kind"))

    days = F.when(~bad, F.transform(times, day))
    items = responses.select(F.inline(F.concat(F.array(whole), F.coalesce(days, F.array().cast(
        "array<struct<year:int,month:int,kind:string>>")))))
    return items.groupBy("year", "month").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ARRIVED])


def month_outcomes(calendar: DataFrame, arrivals: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One row for each month of the calendar and each other month that something arrived for.

    ``loaded``: days were stored; ``quarantined``: only malformed responses or undated
    days; ``empty``: responses without days up to the run; ``missing``: nothing arrived;
    ``outside``: not in the calendar, nothing stored; ``unknown``: no month can be told.
    """
    zero = {c: F.lit(0).cast("long") for c in ARRIVED}
    both = (calendar.select("year", "month").withColumns(zero).withColumn("asked", F.lit(True))
            .unionByName(arrivals.select("year", "month", *ARRIVED).withColumn("asked", F.lit(False))))
    months = both.groupBy("year", "month").agg(F.max("asked").alias("asked"), *[F.sum(c).alias(c) for c in ARRIVED])
    outcome = (F.when(F.col("year").isNull() | F.col("month").isNull(), UNKNOWN)
               .when(~F.col("asked"), OUTSIDE)
               .when(F.col("days_in_time") > 0, LOADED)
               .when(F.col("malformed") + F.col("days_undated") > 0, QUARANTINED)
               .when(F.col("responses") > 0, EMPTY).otherwise(MISSING))
    return months.select(ts_lit(run_ts).alias("run_ts"), "year", "month", outcome.alias("outcome"), *ARRIVED)


def month_history(ledger: DataFrame) -> DataFrame:
    """A8 over several runs, one row a month: ``state`` is ``loaded`` once any run has loaded it, else
    the reason of the last run that asked for it or met it; ``days_loaded`` is that of the last loading run.
    A run that was repeated under its time counts once."""
    runs = ledger.groupBy("year", "month", "run_ts").agg(
        F.max_by(F.struct("outcome", *ARRIVED), F.struct((F.col("outcome") == LOADED).alias("l"), *ARRIVED)).alias("r"))
    loaded = F.col("r.outcome") == LOADED
    return runs.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(loaded).alias("loaded_runs"),
        F.max_by("r.outcome", "run_ts").alias("last_outcome"), F.max("run_ts").alias("last_run"),
        F.coalesce(F.max_by(F.when(loaded, F.col("r.days_in_time")), F.when(loaded, F.col("run_ts"))),
                   F.lit(0).cast("long")).alias("days_loaded"),
        F.sum("r.malformed").alias("malformed"), F.sum("r.days_undated").alias("days_undated")).withColumn(
        "state", F.when(F.col("loaded_runs") > 0, LOADED).otherwise(F.col("last_outcome")))
