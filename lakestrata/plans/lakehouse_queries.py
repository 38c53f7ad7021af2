"""Registered queries of sources, tables and SQL access."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import FILMS_RAW
from ..session import scratch_path
from ..sources import raw_json, tables
from ..sources.testdata import table
from . import films_job
from . import oracle as O
from . import standins
from .registry import register

ROWS_PER_FILE = 50_000


def _n_files(df) -> int:
    return max(1, math.ceil(df.count() / ROWS_PER_FILE))


@register("raw_json_scan", "SELECT * FROM orders")
def raw_json_scan(spark, sf_dir):
    """``orders`` landed as multi-line JSON arrays under a two-level
    tree plus one truncated file; read with an explicit schema over the
    ``*/*.json``-style glob; the malformed record is quarantined."""
    orders = table(spark, sf_dir, "orders")
    landing = scratch_path(spark, "raw_orders")
    raw_json.land_json_arrays(orders, landing, _n_files(orders))
    spark.createDataFrame([('[{"o_orderkey": 1, "o_custkey": ',)], "value string") \
        .write.text(f"{landing}/bucket=truncated")
    raw = raw_json.read_raw_json(spark, f"{landing}/*/*.txt*", orders.schema, multi_line=True)
    good, _bad = raw_json.split_corrupt(raw)
    return good


FILM_RAW_SCHEMA = T.StructType(FILMS_RAW.fields + [
    T.StructField("ingested_at", T.TimestampNTZType()), T.StructField("seq", T.LongType())])


def run_film_tables(spark, sf_dir) -> films_job.FilmsConfig:
    """Land the film stand-in as raw JSON and run bronze -> silver -> gold."""
    films = standins.films(table(spark, sf_dir, "lineitem"))
    landing = scratch_path(spark, "raw_films")
    raw_json.land_json_arrays(films, landing, _n_files(films))
    tag = uuid.uuid4().hex[:8]
    cfg = films_job.FilmsConfig(
        raw_glob=f"{landing}/*/*.txt*", bronze_db=f"bronze_{tag}", silver_db=f"silver_{tag}",
        gold_db=f"gold_{tag}", schema=FILM_RAW_SCHEMA, dedup_order=standins.FILM_DEDUP_ORDER,
        db_root=scratch_path(spark, "lakehouse"))
    films_job.run_films(spark, cfg)
    return cfg


@register("table_roundtrip", "WITH" + O.SILVER_CTE + "\nSELECT * FROM silver")
def table_roundtrip(spark, sf_dir):
    """K1 + S2 + C1-C5: the whole chain through catalog tables; the silver
    table is read back by name."""
    cfg = run_film_tables(spark, sf_dir)
    return tables.read_table(spark, f"{cfg.silver_db}.{cfg.table}")


@register("gold_tables", "WITH" + O.SILVER_CTE + f"""
SELECT 'genre' AS metric_set, genre AS name, NULL::INTEGER AS release_year, count(id) AS movie_count,
       {O.avg2('budget')} AS avg_budget, {O.avg2('box_office')} AS avg_box_office,
       {O.avg2('vote_average')} AS avg_rating, NULL::DOUBLE AS total_box_office
FROM silver GROUP BY genre
UNION ALL
SELECT 'studio', studio, NULL, count(id), {O.avg2('budget')}, {O.avg2('box_office')}, NULL, {O.sum2('box_office')}
FROM silver GROUP BY studio
UNION ALL
SELECT 'year', NULL, release_year, count(id), {O.avg2('budget')}, {O.avg2('box_office')}, {O.avg2('vote_average')}, NULL
FROM silver GROUP BY release_year""")
def gold_tables(spark, sf_dir):
    """C4: the three gold tables that the films job writes, read back by name."""
    cfg = run_film_tables(spark, sf_dir)
    parts = [("genre", "genre"), ("studio", "studio"), ("year", None)]
    out = None
    for kind, name in parts:
        df = tables.read_table(spark, f"{cfg.gold_db}.{kind}_metrics")
        have = lambda c, t, df=df: (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
        df = df.select(F.lit(kind).alias("metric_set"),
                       (F.col(name) if name else F.lit(None)).cast("string").alias("name"),
                       have("release_year", "int"), "movie_count", "avg_budget", "avg_box_office",
                       have("avg_rating", "double"), have("total_box_office", "double"))
        out = df if out is None else out.unionByName(df)
    return out


SQL_TEXT = """
SELECT rating_category, count(id) AS movie_count, round(avg(budget), 2) AS avg_budget,
       count(release_year) AS dated_movies
FROM {view} GROUP BY rating_category"""


@register("sql_access", "WITH" + O.SILVER_CTE + SQL_TEXT.format(view="silver"))
def sql_access(spark, sf_dir):
    """Ad-hoc SQL text over a registered silver view."""
    from .films_queries import silver_films
    view = f"silver_films_{uuid.uuid4().hex[:8]}"
    silver_films(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(SQL_TEXT.format(view=view))
