"""Films medallion: silver cleaning (U2, P1-P3) and gold aggregates.

All functions are lazy ``DataFrame -> DataFrame``; column names are
parameters so the same code runs on fixtures and on stand-ins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RATING_CATEGORIES, RATING_OTHERWISE
from .dedup import OrderItem, dedup_first


def rating_category_expr(rating: Column) -> Column:
    """Exact (case/space-sensitive) code -> category; else and null -> Not Rated."""
    expr = None
    for code, label in RATING_CATEGORIES.items():
        expr = (F.when(rating == code, label) if expr is None
                else expr.when(rating == code, label))
    return expr.otherwise(RATING_OTHERWISE)


def with_rating_category(df: DataFrame, rating: str = "rating",
                         out: str = "rating_category") -> DataFrame:
    return df.withColumn(out, rating_category_expr(F.col(rating)))


def with_release_year(df: DataFrame, date_col: str = "release_date",
                      out: str = "release_year") -> DataFrame:
    """P2 + P3: text -> date in place (null on '' or junk, never an error),
    then the calendar year (null-safe)."""
    return (df.withColumn(date_col, F.try_to_date(F.col(date_col).cast("string")))
              .withColumn(out, F.year(F.col(date_col))))


def silver(df: DataFrame, key: str = "id",
           order: Sequence[OrderItem] | None = None) -> DataFrame:
    """Deterministic dedup on ``key`` -> rating category -> date -> year.

    Columns other than the ones touched pass through unchanged.
    """
    return cleaned(dedup_first(df, [key], order))


def cleaned(films: DataFrame) -> DataFrame:
    """P1-P3 of ``silver``; done again, it changes nothing."""
    return with_release_year(with_rating_category(films))


# Money and ratings are averaged and summed as decimal(38,10): exact, so the
# HALF_UP rounding to cents does not depend on the order rows were added in
# (a double average can land on either side of a half cent).  The rounded
# value is returned as a double, the type of the source metrics.
EXACT = "decimal(38,10)"


def _avg2(c: str) -> Column:
    return F.round(F.avg(F.col(c).cast(EXACT)), 2).cast("double")


def _sum2(c: str) -> Column:
    return F.round(F.sum(F.col(c).cast(EXACT)), 2).cast("double")


def genre_metrics(movies: DataFrame) -> DataFrame:
    """A1: per genre (null genre is a group): non-null id count and rounded
    averages of budget, box office and vote."""
    return movies.groupBy("genre").agg(
        F.count("id").alias("movie_count"),
        _avg2("budget").alias("avg_budget"),
        _avg2("box_office").alias("avg_box_office"),
        _avg2("vote_average").alias("avg_rating"),
    )


def studio_metrics(movies: DataFrame, sort: bool = True) -> DataFrame:
    """A2 + O1: per studio, with total box office; biggest total first
    (nulls last, studio as tie-break)."""
    out = movies.groupBy("studio").agg(
        F.count("id").alias("movie_count"),
        _avg2("budget").alias("avg_budget"),
        _avg2("box_office").alias("avg_box_office"),
        _sum2("box_office").alias("total_box_office"),
    )
    if sort:
        out = out.orderBy(F.col("total_box_office").desc_nulls_last(),
                          F.col("studio").asc_nulls_first())
    return out


def year_metrics(movies: DataFrame, sort: bool = True) -> DataFrame:
    """A3 + O2: per release year (null year -- a bad date -- is a group),
    ascending with nulls first."""
    out = movies.groupBy("release_year").agg(
        F.count("id").alias("movie_count"),
        _avg2("budget").alias("avg_budget"),
        _avg2("box_office").alias("avg_box_office"),
        _avg2("vote_average").alias("avg_rating"),
    )
    if sort:
        out = out.orderBy(F.col("release_year").asc_nulls_first())
    return out


GOLD_SETS = ("genre", "studio", "release_year")


def gold_grouping_sets(movies: DataFrame) -> DataFrame:
    """K7: the three gold aggregates in ONE scan via GROUPING SETS.

    ``metric_set`` names the set a row belongs to (from ``grouping_id``), so
    a null genre group is distinguishable from the other sets' blanks.
    Partial aggregation runs after the Expand, before the single shuffle.
    """
    gid = F.grouping_id("genre", "studio", "release_year")
    # grouping_id bit i (from the right) is 1 when that column is NOT grouped
    g = F.col("_gid")
    set_name = (F.when(g == 3, F.lit("genre"))
                 .when(g == 5, F.lit("studio"))
                 .when(g == 6, F.lit("release_year")))
    agg = (movies.groupingSets(
                [[F.col("genre")], [F.col("studio")], [F.col("release_year")]],
                "genre", "studio", "release_year")
           .agg(gid.alias("_gid"),
                F.count("id").alias("movie_count"),
                _avg2("budget").alias("avg_budget"),
                _avg2("box_office").alias("avg_box_office"),
                _avg2("vote_average").alias("avg_rating"),
                _sum2("box_office").alias("total_box_office")))
    return agg.select(set_name.alias("metric_set"), "genre", "studio", "release_year",
                      "movie_count", "avg_budget", "avg_box_office", "avg_rating",
                      "total_box_office")


# ---------------------------------------------------------------------------
# Mergeable states: gold kept up to date from what a batch changes
# ---------------------------------------------------------------------------
MEASURES = ("budget", "box_office", "vote_average")


def gold_states(changes: DataFrame, weight: str = "_weight") -> DataFrame:
    """Per gold group the counts and exact sums of ``changes``: rows that came in
    (weight 1) and rows that they replaced (weight -1).

    Counts and decimal sums can be added up and taken back without loss, so the
    sum of the states of all batches is the state of the whole table, whatever
    the batches are.  Groups whose state is zero are kept: a batch always leaves rows."""
    w = F.col(weight)
    sums = []
    for m in MEASURES:
        value = F.col(m).cast(EXACT)
        sums += [F.sum(F.when(w < 0, -value).otherwise(value)).cast(EXACT).alias(f"sum_{m}"),
                 F.sum(F.when(F.col(m).isNotNull(), w).otherwise(0)).alias(f"n_{m}")]
    return (changes.groupingSets([[F.col(c)] for c in GOLD_SETS], *GOLD_SETS)
            .agg(F.grouping_id(*GOLD_SETS).alias("_gid"), F.sum(w).alias("n_rows"),
                 F.sum(F.when(F.col("id").isNotNull(), w).otherwise(0)).alias("n_ids"), *sums))


def merge_gold(states: DataFrame) -> DataFrame:
    """The rows of ``gold_grouping_sets`` from the states of all batches; groups without rows are gone."""
    total = (states.groupBy("_gid", *GOLD_SETS)
             .agg(*[F.sum(c).alias(c) for c in ("n_rows", "n_ids", *[f"n_{m}" for m in MEASURES])],
                  *[F.sum(f"sum_{m}").cast(EXACT).alias(f"sum_{m}") for m in MEASURES])
             .where(F.col("n_rows") > 0))

    def known(m: str, value: Column) -> Column:
        return F.when(F.col(f"n_{m}") > 0, F.round(value, 2).cast("double"))

    def mean(m: str) -> Column:
        return known(m, F.col(f"sum_{m}") / F.when(F.col(f"n_{m}") > 0, F.col(f"n_{m}")))

    g = F.col("_gid")
    return total.select(
        F.when(g == 3, F.lit("genre")).when(g == 5, F.lit("studio")).when(g == 6, F.lit("release_year"))
        .alias("metric_set"),
        *GOLD_SETS, F.col("n_ids").alias("movie_count"), mean("budget").alias("avg_budget"),
        mean("box_office").alias("avg_box_office"), mean("vote_average").alias("avg_rating"),
        known("box_office", F.col("sum_box_office")).alias("total_box_office"))
