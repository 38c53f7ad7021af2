"""Stand-ins: the reference's data shapes derived, with Spark, from the driver
tables, so every registered query's work grows with those tables.

Each stand-in has a Spark form here and an equivalent DuckDB CTE in
``lakestrata.plans.oracle``; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Films from lineitem: id = l_orderkey*10 + l_linenumber (real duplicates).
FILM_RATING_BY_LINE = {1: "G", 2: "PG", 3: "PG-13", 4: "R", 5: "NC-17", 6: "pg"}  # 7 -> null
# Dedup order of the film stand-in: no ties at any scale.
FILM_DEDUP_ORDER = [("ingested_at", "desc"), "seq", "studio", "budget"]


def films(lineitem: DataFrame) -> DataFrame:
    line = F.col("l_linenumber")
    rating: Column = F.lit(None).cast("string")
    for n, code in reversed(FILM_RATING_BY_LINE.items()):
        rating = F.when(line == n, F.lit(code)).otherwise(rating)
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd")
    release_date = (F.when(F.col("l_quantity") == 50, F.lit(""))
                     .when(F.col("l_quantity") == 49, F.lit("TBA"))
                     .otherwise(shipped))
    return lineitem.select(
        (F.col("l_orderkey") * 10 + line).alias("id"),
        rating.alias("rating"),
        F.col("l_returnflag").alias("genre"),
        F.col("l_suppkey").cast("string").alias("studio"),
        release_date.alias("release_date"),
        F.col("l_extendedprice").alias("budget"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("box_office"),
        F.col("l_quantity").alias("vote_average"),
        F.col("l_shipdate").alias("ingested_at"),
        F.col("l_partkey").alias("seq"),
    )


# ---------------------------------------------------------------------------
# Job postings from events.  k = props.k (0..99) injects the fixture cases:
# 0 null id, 1 null title, 2 junk created, 3 created with +02:00 offset,
# 4 null created, 5 missing location, 6 location without a name.
# ---------------------------------------------------------------------------
OVERLAP_T1 = "2024-01-15 00:00:00"      # slice B starts here
OVERLAP_T2 = "2024-01-15 12:00:00"      # slice A ends here (12 h overlap)


def postings(events: DataFrame) -> DataFrame:
    """One nested posting per event, plus ``page_no`` (pages of 50)."""
    k = F.from_json("props", "k INT").getField("k")
    ts = F.col("ts")
    created_utc = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    created_sast = F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"),
                                          "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    location = (F.when(k == 5, F.lit(None))
                 .when(k == 6, F.struct(F.lit(None).cast("string").alias("display_name")))
                 .otherwise(F.struct(F.concat(F.lit("City "), (F.col("user_id") % 10).cast("string"))
                                     .alias("display_name"))))
    return events.select(
        F.floor(F.col("event_id") / 50).alias("page_no"),
        F.when(k == 0, F.lit(None)).otherwise(F.concat(F.lit("J"), F.col("event_id").cast("string"))).alias("id"),
        F.when(k == 1, F.lit(None)).otherwise(F.col("event_type")).alias("title"),
        F.col("props").alias("description"),
        F.concat(F.lit("https://jobs.example/"), F.col("event_id").cast("string")).alias("redirect_url"),
        F.when(k == 2, F.lit("not a timestamp")).when(k == 4, F.lit(None))
         .when(k == 3, created_sast).otherwise(created_utc).alias("created"),
        location.alias("location"),
        F.struct(F.concat(F.lit("Company "), F.col("user_id").cast("string")).alias("display_name")).alias("company"),
        F.struct(F.col("event_type").alias("label")).alias("category"),
    )


def job_pages(events: DataFrame) -> DataFrame:
    """API pages: ``{"results": [<=50 postings]}`` per page number.  Each
    collected group is bounded by the page size."""
    p = postings(events)
    body = F.struct(*[c for c in p.columns if c != "page_no"])
    return (p.groupBy("page_no")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("id").alias("_o"), body.alias("b"))))
                 .alias("items"))
            .select("page_no", F.col("items.b").alias("results")))


def overlap_slices(clean: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two extraction windows sharing 12 h.  Slice B re-fetches the overlap
    with a later ``job_created`` and an edited title, and carries an extra
    column (``job_salary``) slice A lacks."""
    created = F.col("job_created")
    a = clean.where(created < F.lit(OVERLAP_T2).cast("timestamp_ntz"))
    in_overlap = created < F.lit(OVERLAP_T2).cast("timestamp_ntz")
    b = (clean.where(created >= F.lit(OVERLAP_T1).cast("timestamp_ntz"))
         .withColumn("job_title", F.when(in_overlap, F.concat("job_title", F.lit(" (updated)")))
                     .otherwise(F.col("job_title")))
         .withColumn("job_created", F.when(in_overlap, created + F.expr("INTERVAL 30 MINUTES"))
                     .otherwise(created))
         .withColumn("job_salary", F.length("job_description").cast("double") * 1000))
    return a, b


# ---------------------------------------------------------------------------
# Pipeline runs and control table from events: one pipeline per event type,
# one run per day; version = run number.
# ---------------------------------------------------------------------------
def pipeline_runs(events: DataFrame) -> DataFrame:
    from pyspark.sql import Window
    runs = (events.groupBy(F.concat(F.lit("jobs_"), F.col("event_type")).alias("state_id"),
                           F.to_date("ts").alias("run_day"))
            .agg(F.count(F.lit(1)).alias("rows_processed"),
                 F.max("ts").alias("last_extraction_time")))
    w = Window.partitionBy("state_id").orderBy("run_day")
    return runs.withColumn("version", F.dense_rank().over(w).cast("long"))


def control_table(events: DataFrame) -> DataFrame:
    from pyspark.sql import Window
    from ..operators.state import run_totals
    runs = run_totals(pipeline_runs(events))
    first = F.min("last_extraction_time").over(Window.partitionBy("state_id"))
    return runs.select("state_id", "version", "last_extraction_time", "total_jobs_extracted",
                       first.alias("created_at"), F.col("last_extraction_time").alias("updated_at"))


# ---------------------------------------------------------------------------
# Weather responses from events: one site per user.  Daily series: one
# response per (user, month), a day per element; hourly series: one response
# per user, an hour per element.  Absent / short series on purpose:
# et0 absent for user_id % 7 = 0, snowfall one short for user_id % 11 = 0,
# visibility absent for user_id % 5 = 0.
# ---------------------------------------------------------------------------
WEATHER_RUN_TS = "2024-02-01 01:00:00"
HOURLY_RUN_TS = "2024-01-15 10:20:00"   # 12:20 in Africa/Johannesburg -> anchor 12:00


def _k() -> Column:
    return F.from_json("props", "k INT").getField("k")


def _count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("double")


def daily_values(events: DataFrame) -> DataFrame:
    """Per (user, day): the 14 daily params (exact arithmetic only)."""
    v, k, et = F.col("value"), _k(), F.col("event_type")
    return (events.withColumn("k", k)
            .groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(F.max(v).alias("temperature_2m_max"),
                 F.min(v).alias("temperature_2m_min"),
                 ((F.max(v) + F.min(v)) / 2).alias("temperature_2m_mean"),
                 F.max("k").cast("double").alias("relative_humidity_2m_max"),
                 F.min("k").cast("double").alias("relative_humidity_2m_min"),
                 ((F.max("k") + F.min("k")).cast("double") / 2).alias("relative_humidity_2m_mean"),
                 _count_if(et == "click").alias("rain_sum"),
                 _count_if(et == "purchase").alias("snowfall_sum"),
                 F.count_distinct(F.hour("ts")).cast("double").alias("precipitation_hours"),
                 F.max(F.when(et == "view", v)).alias("wind_speed_10m_max"),
                 F.max(F.when(et == "error", v)).alias("wind_gusts_10m_max"),
                 F.count(F.lit(1)).cast("double").alias("wind_direction_10m_dominant"),
                 F.round(F.sum(v), 2).alias("shortwave_radiation_sum"),
                 (F.max("k") - F.min("k")).cast("double").alias("et0_fao_evapotranspiration")))


def daily_responses(events: DataFrame) -> DataFrame:
    """(user_id, year, month, daily struct of parallel arrays)."""
    from ..config import DAILY_WEATHER_PARAMS as P
    from ..operators.weather import zip_series
    vals = (daily_values(events)
            .withColumn("time", F.date_format("day", "yyyy-MM-dd"))
            .withColumn("year", F.year("day")).withColumn("month", F.month("day")))
    z = zip_series(vals, ["user_id", "year", "month"], "time", P, out="daily")
    uid = F.col("user_id")
    snow = F.col("daily.snowfall_sum")
    return z.withColumn("daily", F.col("daily")
                        .withField("et0_fao_evapotranspiration",
                                   F.when(uid % 7 == 0, F.lit(None)).otherwise(F.col("daily.et0_fao_evapotranspiration")))
                        .withField("snowfall_sum",
                                   F.when(uid % 11 == 0, F.slice(snow, 1, F.size(snow) - 1)).otherwise(snow)))


def hourly_values(events: DataFrame) -> DataFrame:
    """Per (user, UTC hour): the 12 hourly params, and the zone-less local
    hour label the forecast API would send (Africa/Johannesburg = UTC+2)."""
    v, et = F.col("value"), F.col("event_type")
    hour_utc = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return (events.withColumn("k", _k())
            .groupBy("user_id", hour_utc.alias("hour_utc"))
            .agg(F.max(v).alias("temperature_2m"),
                 F.min(v).alias("relative_humidity_2m"),
                 F.round(F.sum(v), 2).alias("dew_point_2m"),
                 F.max("k").cast("double").alias("apparent_temperature"),
                 F.count(F.lit(1)).cast("double").alias("precipitation"),
                 _count_if(et == "click").alias("rain"),
                 _count_if(et == "view").alias("wind_speed_10m"),
                 _count_if(et == "error").alias("wind_direction_10m"),
                 _count_if(et == "purchase").alias("wind_gusts_10m"),
                 _count_if(et == "signup").alias("surface_pressure"),
                 F.min("k").cast("double").alias("cloud_cover"),
                 (F.max(v) - F.min(v)).alias("visibility"))
            .withColumn("time", F.date_format(F.col("hour_utc") + F.expr("INTERVAL 2 HOURS"),
                                              "yyyy-MM-dd'T'HH:mm")))


def hourly_responses(events: DataFrame) -> DataFrame:
    """(user_id, hourly struct of parallel arrays): at most one element per
    hour of the month per user, so each collected group is bounded."""
    from ..config import HOURLY_WEATHER_PARAMS as P
    from ..operators.weather import zip_series
    z = zip_series(hourly_values(events), ["user_id"], "time", P, out="hourly")
    return z.withColumn("hourly", F.col("hourly").withField(
        "visibility", F.when(F.col("user_id") % 5 == 0, F.lit(None)).otherwise(F.col("hourly.visibility"))))
