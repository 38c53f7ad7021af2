"""Scalar helpers: all JVM built-ins, no UDFs.

Timestamps in the driver tables are ``timestamp_ntz`` holding UTC wall-clock
values.  Zone conversions here work on NTZ values with explicit zones
(``convert_timezone``), so results do not depend on the session zone.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value) -> Column:
    """A ``timestamp_ntz`` literal from a naive datetime (UTC wall clock).

    Built from text: ``F.lit(datetime)`` would read the naive value in the
    Python process's local zone and give an instant, which shifts it on any
    host not set to UTC."""
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_micros(ts: ColumnOrName, ntz: bool = True) -> Column:
    """Microseconds since 1970-01-01 of a timestamp (monotone, for ordering
    and bucketing).  For ``timestamp_ntz`` Spark evaluates the difference in
    the session zone, which the jobs pin to UTC (``session.ensure_utc``)."""
    c = _c(ts)
    if ntz:
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_micros(c)


def utc_to_local(ts_utc: ColumnOrName, zone: str) -> Column:
    """UTC wall clock (NTZ) -> local wall clock (NTZ) in ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts_utc))


def local_to_utc(ts_local: ColumnOrName, zone: str) -> Column:
    """Local wall clock (NTZ) in ``zone`` -> UTC wall clock (NTZ).

    This is how zone-less API hours are read (decision D8): as the zone the
    request asked for, not the host's.
    """
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _c(ts_local))


def utc_offset(ts_utc: ColumnOrName, ts_local: ColumnOrName) -> Column:
    """'+HH:MM' / '-HH:MM' offset between a local and a UTC wall clock."""
    minutes = F.timestamp_diff("MINUTE", _c(ts_utc), _c(ts_local))
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    m = F.abs(minutes)
    return F.concat(sign, F.lpad((m / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((m % 60).cast("string"), 2, "0"))


def iso_local(ts_utc: ColumnOrName, zone: str) -> Column:
    """ISO-8601 text of the local time with its offset, e.g.
    ``2024-01-15T12:00:00+02:00`` (the format ``isoformat()`` gives)."""
    local = utc_to_local(ts_utc, zone)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), utc_offset(ts_utc, local))


def truncate_hour(ts: ColumnOrName) -> Column:
    """Start of the hour, keeping the NTZ type (``date_trunc`` returns TIMESTAMP)."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def date_parts(ts: ColumnOrName) -> list[Column]:
    c = _c(ts)
    return [F.year(c).alias("year"), F.month(c).alias("month"),
            F.dayofmonth(c).alias("day"), F.hour(c).alias("hour")]


def month_label(d: ColumnOrName) -> Column:
    """``YYYY-MM``."""
    return F.date_format(_c(d), "yyyy-MM")


def daily_partition_path(ts: ColumnOrName, prefix: str = "historical",
                         file: str = "weather_data.json") -> Column:
    c = _c(ts)
    return F.format_string(f"{prefix}/year=%d/month=%02d/{file}", F.year(c), F.month(c))


def hourly_partition_path(ts: ColumnOrName, prefix: str = "current",
                          file: str = "weather_data.json") -> Column:
    c = _c(ts)
    return F.format_string(f"{prefix}/year=%d/month=%02d/day=%02d/hour=%02d/{file}",
                           F.year(c), F.month(c), F.dayofmonth(c), F.hour(c))


def json_fields(col: ColumnOrName, ddl: str) -> Column:
    """Parse a JSON text column once into a struct (``from_json``)."""
    return F.from_json(_c(col), ddl)


def parse_iso_timestamp(col: ColumnOrName) -> Column:
    """ISO text -> instant; accepts ``T``, fractions, ``Z`` and offsets; null on junk."""
    return F.try_to_timestamp(_c(col))


def sanitize_name(name: str) -> str:
    """Column name -> lower snake case: accents dropped, camelCase split,
    any other run of non-alphanumerics -> one underscore."""
    name = "".join(ch for ch in unicodedata.normalize("NFKD", name)
                   if not unicodedata.combining(ch))
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    name = re.sub(r"[^A-Za-z0-9]+", "_", name)
    return name.strip("_").lower()
