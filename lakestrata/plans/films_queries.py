"""Registered queries of the films medallion on the ``lineitem`` stand-in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import films as ops
from ..operators.dedup import dedup_first
from ..session import scratch_path
from ..sources.testdata import table
from . import films_job, standins
from . import oracle as O
from .registry import register


def film_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.films(table(spark, sf_dir, "lineitem"))


def silver_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.silver(film_rows(spark, sf_dir), "id", standins.FILM_DEDUP_ORDER)


@register("films_dedup", "WITH" + O.FILMS_DEDUP_CTE + "\nSELECT * FROM films_dedup")
def films_dedup(spark, sf_dir):
    return dedup_first(film_rows(spark, sf_dir), ["id"], standins.FILM_DEDUP_ORDER)


@register("rating_category", "WITH" + O.FILMS_CTE + """
SELECT id, rating,
       CASE rating WHEN 'G' THEN 'General' WHEN 'PG' THEN 'Parental Guidance'
            WHEN 'PG-13' THEN 'Parents Strongly Cautioned' WHEN 'R' THEN 'Restricted'
            WHEN 'NC-17' THEN 'Adults Only' ELSE 'Not Rated' END AS rating_category
FROM films""")
def rating_category(spark, sf_dir):
    return ops.with_rating_category(film_rows(spark, sf_dir).select("id", "rating"))


@register("release_year", "WITH" + O.FILMS_CTE + """
SELECT id, release_date AS release_text, TRY_CAST(release_date AS DATE) AS release_date,
       CAST(year(TRY_CAST(release_date AS DATE)) AS INTEGER) AS release_year
FROM films""")
def release_year(spark, sf_dir):
    f = film_rows(spark, sf_dir).select("id", F.col("release_date").alias("release_text"),
                                        "release_date")
    return ops.with_release_year(f)


@register("genre_metrics", "WITH" + O.SILVER_CTE + f"""
SELECT genre, count(id) AS movie_count, {O.avg2('budget')} AS avg_budget,
       {O.avg2('box_office')} AS avg_box_office, {O.avg2('vote_average')} AS avg_rating
FROM silver GROUP BY genre""")
def genre_metrics(spark, sf_dir):
    return ops.genre_metrics(silver_films(spark, sf_dir))


@register("studio_metrics", "WITH" + O.SILVER_CTE + f"""
SELECT studio, count(id) AS movie_count, {O.avg2('budget')} AS avg_budget,
       {O.avg2('box_office')} AS avg_box_office, {O.sum2('box_office')} AS total_box_office
FROM silver GROUP BY studio ORDER BY total_box_office DESC NULLS LAST, studio""")
def studio_metrics(spark, sf_dir):
    return ops.studio_metrics(silver_films(spark, sf_dir))


@register("year_metrics", "WITH" + O.SILVER_CTE + f"""
SELECT release_year, count(id) AS movie_count, {O.avg2('budget')} AS avg_budget,
       {O.avg2('box_office')} AS avg_box_office, {O.avg2('vote_average')} AS avg_rating
FROM silver GROUP BY release_year ORDER BY release_year NULLS FIRST""")
def year_metrics(spark, sf_dir):
    return ops.year_metrics(silver_films(spark, sf_dir))


GOLD_SQL = "WITH" + O.SILVER_CTE + f"""
SELECT CASE WHEN grouping(genre) = 0 THEN 'genre' WHEN grouping(studio) = 0 THEN 'studio'
            ELSE 'release_year' END AS metric_set,
       genre, studio, release_year,
       count(id) AS movie_count, {O.avg2('budget')} AS avg_budget,
       {O.avg2('box_office')} AS avg_box_office, {O.avg2('vote_average')} AS avg_rating,
       {O.sum2('box_office')} AS total_box_office
FROM silver GROUP BY GROUPING SETS ((genre), (studio), (release_year))"""


@register("gold_grouping_sets", GOLD_SQL)
def gold_grouping_sets(spark, sf_dir):
    return ops.gold_grouping_sets(silver_films(spark, sf_dir))


@register("gold_incremental", GOLD_SQL)
def gold_incremental(spark, sf_dir):
    """K7 from states: all films in three batches, the last one run twice; versions of a film lie in
    several batches, so later ones replace or keep what earlier ones stored."""
    root = scratch_path(spark, "gold_incremental")
    cfg = films_job.IncrementalConfig(f"{root}/silver", f"{root}/states", standins.FILM_DEDUP_ORDER,
                                      parts=int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    rows = film_rows(spark, sf_dir)
    for batch_id in (0, 1, 2, 2):
        films_job.run_films_batch(spark, rows.where(F.pmod("seq", F.lit(3)) == batch_id), batch_id, cfg)
    return films_job.gold_of_batches(spark, cfg)
