"""Configuration knobs and fixed values.

Everything a run needs is an argument; the defaults live here (C13).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the source system's for identical results.
# ---------------------------------------------------------------------------

# Rating code -> rating category (case- and space-sensitive; anything else,
# null included, is "Not Rated").
RATING_CATEGORIES = {
    "G": "General",
    "PG": "Parental Guidance",
    "PG-13": "Parents Strongly Cautioned",
    "R": "Restricted",
    "NC-17": "Adults Only",
}
RATING_OTHERWISE = "Not Rated"

# Daily weather series requested from the archive API, in request order.
DAILY_WEATHER_PARAMS = [
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "relative_humidity_2m_max",
    "relative_humidity_2m_min",
    "relative_humidity_2m_mean",
    "rain_sum",
    "snowfall_sum",
    "precipitation_hours",
    "wind_speed_10m_max",
    "wind_gusts_10m_max",
    "wind_direction_10m_dominant",
    "shortwave_radiation_sum",
    "et0_fao_evapotranspiration",
]

# Hourly weather series requested from the forecast API, in request order.
HOURLY_WEATHER_PARAMS = [
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "apparent_temperature",
    "precipitation",
    "rain",
    "wind_speed_10m",
    "wind_direction_10m",
    "wind_gusts_10m",
    "surface_pressure",
    "cloud_cover",
    "visibility",
]

# The one weather site of the source system.
DEFAULT_SITE_NAME = "Nelspruit, Mpumalanga, South Africa"
DEFAULT_SITE_LATITUDE = -25.4753
DEFAULT_SITE_LONGITUDE = 30.9698
DEFAULT_LOCAL_TIMEZONE = "Africa/Johannesburg"

# Metadata tags written with every weather record.
DAILY_DATA_SOURCE = "open_meteo_historical"
HOURLY_DATA_SOURCE = "open_meteo_current"
WEATHER_API_VERSION = "v1"

# Job-postings pipeline defaults.
DEFAULT_STATE_ID = "postings_pipeline_state"
DEFAULT_SEARCH_PHRASE = "data engineer"
DEFAULT_OVERLAP_HOURS = 12
DEFAULT_LOOKBACK_DAYS = 7
DEFAULT_MAX_ROWS_PER_FILE = 50000
DEFAULT_YEARS_BACK = 3

# Films medallion defaults.
FILMS_TABLE = "movies_info"
BRONZE_DB = "bronze"
SILVER_DB = "silver"
GOLD_DB = "gold"


@dataclass(frozen=True)
class JobsConfig:
    """Knobs of the incremental postings load."""

    search_phrase: str = DEFAULT_SEARCH_PHRASE
    filter_phrase: bool = False      # re-apply the phrase to landed pages (the API already did)
    overlap_hours: int = DEFAULT_OVERLAP_HOURS
    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    max_rows_per_file: int = DEFAULT_MAX_ROWS_PER_FILE
    max_age_cap_days: int | None = None
    database: str = "job_data_lake"
    table: str = "job_postings"
    state_table: str = "pipeline_state"
    state_id: str = DEFAULT_STATE_ID
    table_format: str = "parquet"
    quarantine_table: str = "quarantined_pages"
    ledger_table: str = "landed_files"
    advance_over_quarantined: bool = True    # move the state on although pages were malformed: what replaces
                                             # their file is read for its window
    key_buckets: int | None = None   # bucket the postings table by job_id (large tables)


@dataclass(frozen=True)
class WeatherSite:
    name: str = DEFAULT_SITE_NAME
    latitude: float = DEFAULT_SITE_LATITUDE
    longitude: float = DEFAULT_SITE_LONGITUDE


@dataclass(frozen=True)
class WeatherConfig:
    site: WeatherSite = field(default_factory=WeatherSite)
    local_timezone: str = DEFAULT_LOCAL_TIMEZONE
    years_back: int = DEFAULT_YEARS_BACK
    table_format: str = "parquet"
