"""Registry of the queries exposed through ``__spark_entry__``.

Every query is ``(spark, sf_dir) -> DataFrame`` over the driver tables (or
data Spark derives from them); ``oracle`` holds the DuckDB SQL that must give
the same rows.  Keys without SQL get the weaker rows-only check.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)   # D7: UTC everywhere, whatever the host zone
            return fn(spark, sf_dir)
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so its ``register`` calls run."""
    from . import (films_queries, jobs_queries, lakehouse_queries,  # noqa: F401
                   scalar_queries, stream_queries, weather_queries)
