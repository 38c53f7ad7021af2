"""Table I/O: catalog tables (K1, S2), partition overwrite (K2, K3),
insert-if-new appends with a file cap (J1 + K4) and load receipts (K5).

The table format is a parameter: ``parquet`` by default, ``delta`` when its
jar is on the classpath.  Paths always come from the caller; databases are
created at an explicit location so nothing lands in a working directory.
"""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import ts_lit
from ..operators.dedup import dedup_first
from ..session import checkpoint_root


class SchemaChangeError(ValueError):
    """Overwriting a table with a different schema without ``allow_schema_change``."""


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (fixes the never-created database, D17)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{loc}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _schema_sig(df_schema) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df_schema.fields]


def write_table(df: DataFrame, name: str, *, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: list[str] | None = None, allow_schema_change: bool = False,
                max_records_per_file: int | None = None,
                bucket_by: tuple[int, str] | None = None) -> None:
    """K1: write ``df`` as catalog table ``name`` (``db.table``).

    Plain Parquet would silently replace a changed schema on overwrite; here
    a changed schema is refused unless ``allow_schema_change`` -- the same
    guard a Delta table gives.
    """
    spark = df.sparkSession
    if table_exists(spark, name) and not allow_schema_change:
        old = _schema_sig(spark.table(name).schema)
        new = _schema_sig(df.schema)
        if mode == "overwrite" and partition_by:
            # partition columns move to the end in the catalog schema
            new = [c for c in new if c[0] not in partition_by] + [c for c in new if c[0] in partition_by]
            old = [c for c in old if c[0] not in partition_by] + [c for c in old if c[0] in partition_by]
        if sorted(old) != sorted(new):
            raise SchemaChangeError(f"schema of {name} would change: {old} -> {new}")
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if bucket_by:
        # (n, key): rows hash into n buckets by key; joins and aggregates on
        # the key then read the stored side without shuffling it
        w = w.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    if fmt == "parquet":
        w = w.option("compression", "snappy")
    w.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Latest version of a table, by catalog name (fixes the path mix-up, D1)."""
    return spark.table(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str],
                         fmt: str = "parquet", **options) -> None:
    """K2/K3: replace exactly the partitions present in ``df``; all others
    stay.  Re-running a month/hour replaces it (idempotent refresh)."""
    w = (df.write.format(fmt).mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by))
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


def merge_partitions(df: DataFrame, path: str, partition_by: list[str], key: list[str],
                     latest: list[str] | None = None, fmt: str = "parquet", **options) -> None:
    """K2/K3/T4 keyed by record: rows of ``df`` replace the stored rows with
    the same partition and ``key``; every other stored row stays.

    Of several rows of ``df`` with one key the one that comes last by the
    ``latest`` columns wins (ties: the last by all columns, nested ones included,
    so a replay gives the same rows).  Only the touched partitions are read
    (``in_partitions``: their values are literals in the scan) and rewritten; the
    merged rows are checkpointed first, for a write may not read what it
    replaces.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    names = [*partition_by, *key]
    order = [(c, "desc") for c in [*(latest or []), *[c for c in df.columns if c not in names and c not in (latest or [])]]]
    batch = dedup_first(df, names, order).checkpoint()
    if batch.isEmpty():
        return
    merged = batch
    stored = stored_rows(spark, path, df.schema, fmt)
    if stored is not None:
        touched = in_partitions(stored, batch, partition_by)
        untouched = touched.alias("s").join(batch.select(*names).alias("b"), _same(names), "left_anti")
        merged = batch.unionByName(untouched.select(*batch.columns)).checkpoint()
    overwrite_partitions(merged.hint("rebalance", *partition_by), path, partition_by, fmt=fmt, **options)


def _same(names: list[str]) -> Column:
    """Equal values, nulls included, of the frames aliased ``s`` and ``b``."""
    return functools.reduce(lambda x, y: x & y, [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names])


def in_partitions(stored: DataFrame, batch: DataFrame, partition_by: list[str]) -> DataFrame:
    """The stored rows of the partitions that ``batch`` touches.

    The values of each partition column that occur in the batch (at most as many
    as it has partitions) go into the scan as literals, so only these
    folders are opened; of several columns, a semi join then leaves out combinations that the
    batch does not have.
    """
    combinations = batch.select(*partition_by).distinct().collect()
    rows = stored
    for c in partition_by:
        kind = stored.schema[c].dataType
        values = sorted({r[c] for r in combinations if r[c] is not None})
        here = F.col(c).isin([F.lit(v).cast(kind) for v in values]) if values else F.lit(False)
        rows = rows.where(here | F.col(c).isNull() if any(r[c] is None for r in combinations) else here)
    if len(combinations) == 1 or len(partition_by) == 1:      # the literals say it all
        return rows
    wanted = stored.sparkSession.createDataFrame(
        [tuple(r) for r in combinations], StructType([stored.schema[c] for c in partition_by]))
    return rows.alias("s").join(wanted.alias("b"), _same(partition_by), "left_semi")


def upsert_latest_rows(df: DataFrame, path: str, key: str, latest: list[str], parts: int,
                       fmt: str = "parquet", **options) -> None:
    """J1, latest wins, as a stored table: of the stored rows and those of ``df`` with one ``key`` the one
    that comes last by the ``latest`` columns stays (ties: the last by all columns).

    Rows lie in ``parts`` folders by a hash of the key (``hash_of_<parts>``, a
    number fixed for the table's life; another one is refused).  Only the folders that
    the batch touches are read and rewritten, the files of the others stay.
    Rows without a key are all kept, in a folder of their own choice by their content.
    Batch and stored rows meet in one aggregate, which deals them out as the folders do.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    part = part_column(parts)
    no_key = F.col(key).isNull()
    own = F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int")
    batch = df.withColumn(part, F.when(no_key, own).otherwise(hash_part([key], parts))).checkpoint()
    if batch.isEmpty():
        return
    order = [(c, "desc") for c in [*latest, *[c for c in df.columns if c != key and c not in latest]]]
    rows = batch
    stored = stored_rows(spark, path, batch.schema, fmt)
    if stored is not None:
        refuse_other_parts(spark, path, part, fmt)
        rows = batch.unionByName(in_partitions(stored, batch, [part]).select(*batch.columns))
    with_key = dedup_first(rows.where(~no_key).drop(part), [key], order).withColumn(part, hash_part([key], parts))
    merged = dealt_by(with_key, part, parts).unionByName(rows.where(no_key).repartition(part)).checkpoint()
    overwrite_partitions(merged, path, [part], fmt=fmt, **options)


def part_column(parts: int) -> str:
    return f"hash_of_{parts}"


def hash_part(keys: list[str], parts: int) -> Column:
    """The folder of a row by the hash that an aggregate by ``keys`` deals its rows out by."""
    return F.pmod(F.hash(*keys), F.lit(parts))


def dealt_by(df: DataFrame, part: str, parts: int) -> DataFrame:
    """``df``, an aggregate by the keys of ``hash_part``, with each folder's rows in one task; they are
    there already if the session shuffles to as many partitions as there are parts."""
    conf = df.sparkSession.conf
    shuffled_to = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) \
        or conf.get("spark.sql.shuffle.partitions")
    return df if int(shuffled_to) == parts else df.repartition(part)


def refuse_other_parts(spark: SparkSession, path: str, part: str, fmt: str) -> None:
    """A key of a table must have one folder: rows laid out otherwise would not be found."""
    if part not in spark.read.format(fmt).load(path).columns:
        raise ValueError(f"{path} has another number of parts than {part} tells, or another hash")


def stored_rows(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame | None:
    """What a folder holds, or None if there is no such folder; only its absence is caught."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write into this folder has been committed."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def kept_rows(df: DataFrame, path: str) -> DataFrame:
    """``df`` added to a scratch folder, and all rows of that folder.  The files are smaller than those of
    ``checkpoint()``, and the caller can remove them (``scratch_folder``)."""
    df.write.mode("append").option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_only(batch: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """J1 insert-if-new: rows of ``batch`` whose key is not stored yet.

    Two steps: the stored keys are first cut down to the batch's (a semi join
    whose small side is the batch, so adaptive execution may broadcast it and
    the stored side is not shuffled), then the batch is anti joined with
    that small match.  Only the key column of the stored table is read.
    """
    wanted = batch.select(key).where(F.col(key).isNotNull()).distinct()
    seen = existing.select(key).join(wanted, key, "left_semi").distinct()
    return batch.join(seen, on=key, how="left_anti")


@dataclass
class Receipt:
    """K5: what a load wrote."""
    new_jobs: int
    files_written: int
    table_updated: bool


def append_new(batch: DataFrame, name: str, key: str, *, partition_by: list[str],
               run_marker: dict[str, object] | None = None, fmt: str = "parquet",
               max_records_per_file: int | None = None,
               bucket_by: tuple[int, str] | None = None) -> Receipt:
    """J1 + K4 + K5: append the not-yet-stored rows of ``batch`` to table
    ``name`` (created on first use) and return a receipt.

    The row count is observed during the write itself (no second pass).
    ``run_marker`` = {audit column: this run's value} lets the receipt count
    the files this run wrote from the stored rows that carry the marker;
    include the partition column so that count reads one partition.
    ``bucket_by`` = (n, key) stores the table bucketed by key: the anti join
    of later runs then shuffles only the (small) batch, never the table.
    """
    spark = batch.sparkSession
    checkpoint_root(spark)
    # the batch is read twice below (its keys, its rows); a key that comes
    # twice in it is stored once: the first by all columns
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())     # rows without a key are all kept
    batch = (dedup_first(batch.withColumn("_no_key", own), [key, "_no_key"]).drop("_no_key").checkpoint())
    to_write = new_only(batch, spark.table(name), key) if table_exists(spark, name) else batch
    if bucket_by:       # one file per bucket and partition, not one per task, bucket and partition
        to_write = to_write.repartition(bucket_by[0], F.col(bucket_by[1]))
    obs = Observation("append_new")
    to_write = to_write.observe(obs, F.count(F.lit(1)).alias("rows"))
    write_table(to_write, name, mode="append", fmt=fmt, partition_by=partition_by,
                max_records_per_file=max_records_per_file, bucket_by=bucket_by)
    rows = int(obs.get.get("rows", 0) or 0)
    files = 0
    if rows and run_marker:
        stored = spark.table(name)
        cond = F.lit(True)
        for col, value in run_marker.items():
            lit = ts_lit(value) if isinstance(value, dt.datetime) else F.lit(value)
            cond = cond & (F.col(col) == lit.cast(stored.schema[col].dataType))
        files = stored.where(cond).select("_metadata.file_path").distinct().count()
    return Receipt(new_jobs=rows, files_written=int(files), table_updated=rows > 0)
