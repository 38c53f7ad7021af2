"""DuckDB SQL for the stand-ins and the oracle of every registered query.

The CTEs mirror ``lakestrata.plans.standins`` column for column.  Types are
cast to what Spark returns (``year()`` is INTEGER there, BIGINT here).
"""

from __future__ import annotations

FILMS_CTE = """
films AS (
  SELECT l_orderkey * 10 + l_linenumber AS id,
         CASE l_linenumber WHEN 1 THEN 'G' WHEN 2 THEN 'PG' WHEN 3 THEN 'PG-13'
              WHEN 4 THEN 'R' WHEN 5 THEN 'NC-17' WHEN 6 THEN 'pg' END AS rating,
         l_returnflag AS genre,
         CAST(l_suppkey AS VARCHAR) AS studio,
         CASE WHEN l_quantity = 50 THEN '' WHEN l_quantity = 49 THEN 'TBA'
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS release_date,
         l_extendedprice AS budget,
         l_extendedprice + l_quantity AS box_office,
         l_quantity AS vote_average,
         l_shipdate AS ingested_at,
         l_partkey AS seq
  FROM lineitem)"""

FILMS_DEDUP_CTE = FILMS_CTE + """,
films_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST,
           seq ASC NULLS FIRST, studio ASC NULLS FIRST, budget ASC NULLS FIRST) AS rn
    FROM films) WHERE rn = 1)"""

SILVER_CTE = FILMS_DEDUP_CTE + """,
silver AS (
  SELECT id, rating, genre, studio, TRY_CAST(release_date AS DATE) AS release_date,
         budget, box_office, vote_average, ingested_at, seq,
         CASE rating WHEN 'G' THEN 'General' WHEN 'PG' THEN 'Parental Guidance'
              WHEN 'PG-13' THEN 'Parents Strongly Cautioned' WHEN 'R' THEN 'Restricted'
              WHEN 'NC-17' THEN 'Adults Only' ELSE 'Not Rated' END AS rating_category,
         CAST(year(TRY_CAST(release_date AS DATE)) AS INTEGER) AS release_year
  FROM films_dedup)"""

POSTINGS_CTE = """
ev AS (
  SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
flat AS (
  SELECT CASE WHEN k = 0 THEN NULL ELSE 'J' || event_id END AS job_id,
         CASE WHEN k = 1 THEN NULL ELSE event_type END AS job_title,
         CASE WHEN k IN (5, 6) THEN NULL ELSE 'City ' || (user_id % 10) END AS job_location,
         'Company ' || user_id AS job_company,
         event_type AS job_category,
         props AS job_description,
         'https://jobs.example/' || event_id AS job_url,
         CASE WHEN k = 2 THEN 'not a timestamp' WHEN k = 4 THEN NULL
              WHEN k = 3 THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+02:00'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS job_created
  FROM ev),
clean AS (
  SELECT 'J' || event_id AS job_id, event_type AS job_title,
         CASE WHEN k IN (5, 6) THEN NULL ELSE 'City ' || (user_id % 10) END AS job_location,
         'Company ' || user_id AS job_company, event_type AS job_category,
         props AS job_description, 'https://jobs.example/' || event_id AS job_url,
         ts AS job_created
  FROM ev WHERE k NOT IN (0, 1, 2, 4)),
slice_a AS (
  SELECT * FROM clean WHERE job_created < TIMESTAMP '2024-01-15 12:00:00'),
slice_b AS (
  SELECT job_id,
         CASE WHEN job_created < TIMESTAMP '2024-01-15 12:00:00' THEN job_title || ' (updated)'
              ELSE job_title END AS job_title,
         job_location, job_company, job_category, job_description, job_url,
         CASE WHEN job_created < TIMESTAMP '2024-01-15 12:00:00' THEN job_created + INTERVAL 30 MINUTE
              ELSE job_created END AS job_created,
         CAST(length(job_description) AS DOUBLE) * 1000 AS job_salary
  FROM clean WHERE job_created >= TIMESTAMP '2024-01-15 00:00:00')"""

STATE_CTE = """
runs AS (
  SELECT state_id, run_day, rows_processed, last_extraction_time,
         CAST(dense_rank() OVER (PARTITION BY state_id ORDER BY run_day) AS BIGINT) AS version
  FROM (SELECT 'jobs_' || event_type AS state_id, CAST(ts AS DATE) AS run_day,
               count(*) AS rows_processed, max(ts) AS last_extraction_time
        FROM events GROUP BY 1, 2)),
state AS (
  SELECT state_id, version, last_extraction_time,
         CAST(sum(rows_processed) OVER (PARTITION BY state_id ORDER BY version
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_jobs_extracted,
         min(last_extraction_time) OVER (PARTITION BY state_id) AS created_at,
         last_extraction_time AS updated_at
  FROM runs)"""

WEATHER_CTE = """
wev AS (
  SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
daily_vals AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
         max(value) AS temperature_2m_max, min(value) AS temperature_2m_min,
         (max(value) + min(value)) / 2 AS temperature_2m_mean,
         CAST(max(k) AS DOUBLE) AS relative_humidity_2m_max,
         CAST(min(k) AS DOUBLE) AS relative_humidity_2m_min,
         CAST(max(k) + min(k) AS DOUBLE) / 2 AS relative_humidity_2m_mean,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) AS rain_sum,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS snowfall_sum,
         CAST(count(DISTINCT hour(ts)) AS DOUBLE) AS precipitation_hours,
         max(value) FILTER (WHERE event_type = 'view') AS wind_speed_10m_max,
         max(value) FILTER (WHERE event_type = 'error') AS wind_gusts_10m_max,
         CAST(count(*) AS DOUBLE) AS wind_direction_10m_dominant,
         round(sum(value), 2) AS shortwave_radiation_sum,
         CAST(max(k) - min(k) AS DOUBLE) AS et0_fao_evapotranspiration
  FROM wev GROUP BY 1, 2),
daily_rows AS (
  SELECT user_id AS site_id, day AS date,
         temperature_2m_max, temperature_2m_min, temperature_2m_mean,
         relative_humidity_2m_max, relative_humidity_2m_min, relative_humidity_2m_mean, rain_sum,
         CASE WHEN user_id % 11 = 0
                   AND day = max(day) OVER (PARTITION BY user_id, year(day), month(day))
              THEN NULL ELSE snowfall_sum END AS snowfall_sum,
         precipitation_hours, wind_speed_10m_max, wind_gusts_10m_max, wind_direction_10m_dominant,
         shortwave_radiation_sum,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE et0_fao_evapotranspiration END AS et0_fao_evapotranspiration,
         'Nelspruit, Mpumalanga, South Africa' AS location_name,
         -25.4753 ::DOUBLE AS latitude, 30.9698 ::DOUBLE AS longitude,
         'open_meteo_historical' AS data_source, 'v1' AS api_version,
         TIMESTAMP '2024-02-01 01:00:00' AS collected_at,
         CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month
  FROM daily_vals),
hourly_vals AS (
  SELECT user_id, date_trunc('hour', ts) AS hour_utc,
         max(value) AS temperature_2m, min(value) AS relative_humidity_2m,
         round(sum(value), 2) AS dew_point_2m, CAST(max(k) AS DOUBLE) AS apparent_temperature,
         CAST(count(*) AS DOUBLE) AS precipitation,
         CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) AS rain,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS DOUBLE) AS wind_speed_10m,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS DOUBLE) AS wind_direction_10m,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS wind_gusts_10m,
         CAST(count(*) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS surface_pressure,
         CAST(min(k) AS DOUBLE) AS cloud_cover,
         CASE WHEN user_id % 5 = 0 THEN NULL ELSE max(value) - min(value) END AS visibility
  FROM wev GROUP BY 1, 2),
nearest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id
              ORDER BY (hour_utc <= TIMESTAMP '2024-01-15 10:00:00') DESC,
                       abs(epoch(hour_utc) - epoch(TIMESTAMP '2024-01-15 10:00:00')),
                       hour_utc) AS rn
    FROM hourly_vals) WHERE rn = 1),
hour_rows AS (
  SELECT user_id AS site_id,
         strftime(hour_utc + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS timestamp,
         CAST(hour_utc + INTERVAL 2 HOUR AS DATE) AS date,
         CAST(hour(hour_utc + INTERVAL 2 HOUR) AS INTEGER) AS hour,
         temperature_2m, relative_humidity_2m, dew_point_2m, apparent_temperature, precipitation,
         rain, wind_speed_10m, wind_direction_10m, wind_gusts_10m, surface_pressure, cloud_cover,
         visibility,
         'Nelspruit, Mpumalanga, South Africa' AS location_name,
         'open_meteo_current' AS data_source, 'v1' AS api_version,
         TIMESTAMP '2024-01-15 10:20:00' AS collected_at, 'Africa/Johannesburg' AS local_timezone,
         CAST(year(hour_utc + INTERVAL 2 HOUR) AS INTEGER) AS year,
         CAST(month(hour_utc + INTERVAL 2 HOUR) AS INTEGER) AS month,
         CAST(day(hour_utc + INTERVAL 2 HOUR) AS INTEGER) AS day
  FROM nearest)"""


def avg2(x: str) -> str:
    """Exact HALF_UP average to cents for non-negative cent values (integer math)."""
    cents = f"CAST(round({x} * 100) AS BIGINT)"
    return f"((2 * sum({cents}) + count({x})) // (2 * count({x}))) / 100.0"


def sum2(x: str) -> str:
    return f"sum(CAST(round({x} * 100) AS BIGINT)) / 100.0"
