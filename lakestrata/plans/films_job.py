"""Films medallion jobs (C1, C3, C4, C5): bronze -> silver -> gold tables.

Each step reads its input table by catalog name and overwrites its output
table; an exception stops the chain, so a layer is only rebuilt from a
fully written upstream layer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import BRONZE_DB, FILMS_TABLE, GOLD_DB, SILVER_DB
from ..operators import films as ops
from ..operators.dedup import OrderItem, dedup_first, dedup_sides
from ..schemas import CORRUPT_COLUMN, FILMS_RAW
from ..session import checkpoint_root, scratch_folder, shuffles_dropped
from ..sources import raw_json, tables


@dataclass(frozen=True)
class FilmsConfig:
    raw_glob: str                       # e.g. ".../films/*/*.json"
    bronze_db: str = BRONZE_DB
    silver_db: str = SILVER_DB
    gold_db: str = GOLD_DB
    table: str = FILMS_TABLE
    fmt: str = "parquet"
    schema: StructType = FILMS_RAW
    dedup_order: Sequence[OrderItem] | None = None
    single_scan_gold: bool = True
    db_root: str | None = None          # location for the three databases


def bronze(spark: SparkSession, cfg: FilmsConfig) -> None:
    """Raw JSON (explicit schema) -> bronze table, in one scan.  Bronze
    keeps every record; a malformed one has only ``_corrupt_record`` set and
    is quarantined by ``quarantine`` (silver never sees it)."""
    raw = raw_json.read_raw_json(spark, cfg.raw_glob, cfg.schema, multi_line=True)
    tables.write_table(raw, f"{cfg.bronze_db}.{cfg.table}", fmt=cfg.fmt)


def quarantine(spark: SparkSession, cfg: FilmsConfig) -> DataFrame:
    """Malformed raw records kept in bronze."""
    b = tables.read_table(spark, f"{cfg.bronze_db}.{cfg.table}")
    return b.where(F.col(CORRUPT_COLUMN).isNotNull())


def silver(spark: SparkSession, cfg: FilmsConfig) -> None:
    """Bronze table -> deterministic dedup, rating category, date, year."""
    films, _ = raw_json.split_corrupt(tables.read_table(spark, f"{cfg.bronze_db}.{cfg.table}"))
    tables.write_table(ops.silver(films, "id", cfg.dedup_order),
                       f"{cfg.silver_db}.{cfg.table}", fmt=cfg.fmt)


def split_gold_sets(sets: DataFrame) -> dict[str, DataFrame]:
    """The three gold tables out of one GROUPING SETS result."""
    base = ["movie_count", "avg_budget", "avg_box_office"]
    m = F.col("metric_set")
    return {
        "genre_metrics": sets.where(m == "genre").select("genre", *base, "avg_rating"),
        "studio_metrics": sets.where(m == "studio").select("studio", *base, "total_box_office"),
        "year_metrics": sets.where(m == "release_year").select("release_year", *base, "avg_rating"),
    }


def gold(spark: SparkSession, cfg: FilmsConfig) -> None:
    """C4: silver -> genre / studio / year metrics tables.

    ``single_scan_gold``: one GROUPING SETS pass over silver; its result is
    tiny (one row per group) and is checkpointed to the shared checkpoint
    folder so the three writes do not each rescan silver.  Otherwise three
    column-pruned aggregates.  Files are not sorted: a sorted write does not
    make an ordered table (order when reading)."""
    movies = tables.read_table(spark, f"{cfg.silver_db}.{cfg.table}")
    if cfg.single_scan_gold:
        checkpoint_root(spark)
        frames = split_gold_sets(ops.gold_grouping_sets(movies).checkpoint(eager=True))
    else:
        frames = {"genre_metrics": ops.genre_metrics(movies),
                  "studio_metrics": ops.studio_metrics(movies, sort=False),
                  "year_metrics": ops.year_metrics(movies, sort=False)}
    for name, df in frames.items():
        tables.write_table(df, f"{cfg.gold_db}.{name}", fmt=cfg.fmt)


def run_films(spark: SparkSession, cfg: FilmsConfig) -> dict:
    """Bronze -> silver -> gold, each only after the previous succeeded."""
    for db in (cfg.bronze_db, cfg.silver_db, cfg.gold_db):
        tables.ensure_database(spark, db, f"{cfg.db_root}/{db}.db" if cfg.db_root else None)
    bronze(spark, cfg)
    silver(spark, cfg)
    gold(spark, cfg)
    return {"quarantined": quarantine(spark, cfg).count()}


@dataclass(frozen=True)
class IncrementalConfig:
    silver_path: str                    # survivors, in folders by a hash of the id
    states_path: str                    # one folder of gold states a batch
    order: Sequence[OrderItem]          # total order of the versions of a film, first wins
    parts: int = 64                     # fixed for the table's life
    fmt: str = "parquet"
    slices: int = 4                     # at most so many groups of folders are merged one after another


def run_films_batch(spark: SparkSession, batch: DataFrame, batch_id: int, cfg: IncrementalConfig) -> None:
    """C3 + C4 for a batch of films: silver takes its new survivors, and the
    change of gold is written as states; no other part of silver is read.

    A film's stored version that a batch replaces enters its states with weight
    -1.  The states are written before silver and only once for a batch (they are
    complete when their folder holds ``_SUCCESS``, which the committer must be set to write), so a batch may be run
    again after a crash at any point.  Batches run one after another, in any order.

    Batch and stored rows meet in one aggregate, without the columns that are made from others; it deals
    rows out as silver's folders do.  Folders are merged in up to ``slices`` groups, so that
    only one group's shuffle lies on disk at a time; each has folders for all cores.  What is kept between steps
    (the batch, the merged rows) are scratch files that go when the batch ends.
    """
    with scratch_folder(spark, "films_batch") as kept, shuffles_dropped(spark):
        merged, schema = _merged_films(spark, batch, cfg, kept)
        if merged is None:
            return
        part, states = tables.part_column(cfg.parts), f"{cfg.states_path}/batch={batch_id}"
        if not tables.is_complete(spark, states):
            came = merged.where("_came")
            before = ops.with_release_year(came.where(F.col("_old").isNotNull()).select("id", "_old.*"))
            changes = [side.select("id", *ops.GOLD_SETS, *ops.MEASURES, F.lit(weight).alias("_weight"))
                       for side, weight in ((came, 1), (before, -1))]
            ops.gold_states(changes[0].unionByName(changes[1])).write.format(cfg.fmt).mode("overwrite").save(states)
        changed = merged.where("_changed")
        if changed.isEmpty():               # the batch has been stored
            return
        survivors = tables.in_partitions(merged, changed, [part]).select(*schema.names)
        tables.overwrite_partitions(tables.dealt_by(survivors, part, cfg.parts), cfg.silver_path, [part], fmt=cfg.fmt)


def _merged_films(spark: SparkSession, batch: DataFrame, cfg: IncrementalConfig,
                  kept: str) -> tuple[DataFrame | None, StructType | None]:
    """``dedup_sides`` of a batch and the stored rows of its folders, kept below ``kept``, with the columns
    that are made from others, and the schema of silver; None for a batch without rows."""
    part, folder = tables.part_column(cfg.parts), tables.hash_part(["id"], cfg.parts)
    made = ("rating_category", "release_year")
    if any((item if isinstance(item, str) else item[0]) == "release_date" for item in cfg.order):
        batch = dedup_first(batch, ["id"], cfg.order)       # by its text, which silver doesn't keep
    with scratch_folder(spark, "films_rows") as path:
        rows = tables.kept_rows(ops.cleaned(batch).drop(*made), path).withColumn(part, folder)
        touched = sorted(r[0] for r in rows.select(part).distinct().collect())
        if not touched:
            return None, None
        schema = ops.cleaned(rows).schema
        stored = tables.stored_rows(spark, cfg.silver_path, schema, cfg.fmt)
        if stored is not None:
            tables.refuse_other_parts(spark, cfg.silver_path, part, cfg.fmt)
        n = max(1, min(cfg.slices, len(touched) // spark.sparkContext.defaultParallelism))
        for folders in (touched[i::n] for i in range(n)):
            new, old = [None if side is None else side.where(F.col(part).isin(folders)).select(*rows.columns).drop(part)
                        for side in (rows, stored)]
            merged = tables.kept_rows(dedup_sides(new, new.limit(0) if old is None else old, ["id"], cfg.order), kept)
    return ops.cleaned(merged).withColumn(part, folder), schema


def gold_of_batches(spark: SparkSession, cfg: IncrementalConfig) -> DataFrame:
    """Gold after the batches run so far: equal to ``gold_grouping_sets`` over silver, which isn't read."""
    return ops.merge_gold(spark.read.format(cfg.fmt).load(cfg.states_path))
