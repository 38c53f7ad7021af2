"""Versioned pipeline state as an append-only control table.

Each commit appends ``(state_id, version+1, ...)``; the current state is the
row with the highest version per ``state_id``.  A commit first claims its
version with a create-if-absent write beside the table, so of two runs that
race for one version exactly one goes on and the other is refused (the
conditional put of the source).  Old rows are never rewritten, so ``created_at`` survives (D9).
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import ts_lit
from ..schemas import PIPELINE_STATE
from ..session import local_fs_path

STATE_COLUMNS = [f.name for f in PIPELINE_STATE.fields]


class VersionConflict(RuntimeError):
    """Another run committed this version first."""


def current_state(state: DataFrame) -> DataFrame:
    """K6: latest version per ``state_id`` -- a partial aggregate, one shuffle
    of at most (tasks x pipelines) rows."""
    row = F.struct(*[F.col(c) for c in STATE_COLUMNS if c != "state_id"])
    return (state.groupBy("state_id")
            .agg(F.max_by(row, F.col("version")).alias("s"))
            .select("state_id", "s.*"))


def state_as_of(state: DataFrame, as_of) -> DataFrame:
    """The state each pipeline had at time ``as_of`` (versions updated at or before)."""
    return current_state(state.where(F.col("updated_at") <= ts_lit(as_of)))


def with_defaults(requested: DataFrame, state: DataFrame, run_ts: dt.datetime,
                  lookback_days: int = 7) -> DataFrame:
    """Current state of each requested ``state_id``; a pipeline never run
    gets the default -- ``run_ts - lookback_days``, total 0, version 0.
    Read errors are *not* turned into a first run (D10): they raise."""
    cur = current_state(state)
    default_ts = ts_lit(run_ts - dt.timedelta(days=lookback_days))
    j = requested.select("state_id").join(cur, "state_id", "left")
    return j.select(
        "state_id",
        F.coalesce("version", F.lit(0).cast("long")).alias("version"),
        F.coalesce("last_extraction_time", default_ts).alias("last_extraction_time"),
        F.coalesce("total_jobs_extracted", F.lit(0).cast("long")).alias("total_jobs_extracted"),
        F.col("version").isNull().alias("is_default"),
    )


def run_totals(runs: DataFrame, state_id: str = "state_id", version: str = "version",
               rows: str = "rows_processed") -> DataFrame:
    """Rows per run and the running total per pipeline.  The window is
    over run rows (one per run), partitioned by pipeline -- never over data."""
    w = (Window.partitionBy(state_id).orderBy(version)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return runs.withColumn("total_jobs_extracted", F.sum(rows).over(w))


def window_from_state(batch: DataFrame, state: DataFrame, run_ts: dt.datetime,
                      overlap_hours: int, key: str = "state_id",
                      ts: str = "job_created") -> DataFrame:
    """Each pipeline's window ``[last_extraction_time - overlap, run_ts]``
    attached to its rows and applied (both ends inclusive).

    ``state`` holds one current row per pipeline; no hint is given, so
    adaptive execution chooses the join by the side's bytes."""
    bounds = state.select(
        key,
        (F.col("last_extraction_time") - F.expr(f"INTERVAL {int(overlap_hours)} HOURS"))
        .alias("window_start"),
        ts_lit(run_ts).alias("window_end"))
    j = batch.join(bounds, key)
    return j.where(F.col(ts).between(F.col("window_start"), F.col("window_end")))


def next_state_row(spark: SparkSession, current: dict | None, state_id: str,
                   run_ts: dt.datetime, jobs_added: int,
                   updated_at: dt.datetime | None = None) -> DataFrame:
    """The row a successful run appends (version + 1, totals carried);
    ``run_ts`` is the new high-water mark, ``updated_at`` the run's clock if that differs."""
    updated_at = updated_at or run_ts
    version = (current or {}).get("version", 0) + 1
    total = (current or {}).get("total_jobs_extracted", 0) + jobs_added
    created = (current or {}).get("created_at") or updated_at
    return spark.createDataFrame(
        [(state_id, version, run_ts, total, created, updated_at)], PIPELINE_STATE)


#: A claim without its state row counts as given up after this time.
STALE_AFTER = dt.timedelta(hours=1)


def commit_state(spark: SparkSession, table: str, state_id: str, expected_version: int,
                 run_ts: dt.datetime, jobs_added: int, fmt: str = "parquet", run_id: str | None = None,
                 stale_after: dt.timedelta = STALE_AFTER) -> int:
    """K6: append version ``expected_version + 1`` unless someone else already
    did (conflict -> ``VersionConflict``).  Called only after the data write
    succeeded (D6).  Returns the new version.

    ``run_id`` names the run in its claim: a run that died after its claim and is
    started again under the same name goes on with it; any other run may take
    the claim over once it is ``stale_after`` old."""
    current = None
    if spark.catalog.tableExists(table):
        rows = (current_state(spark.table(table).where(F.col("state_id") == state_id))
                .collect())  # one row at most
        current = rows[0].asDict() if rows else None
    have = (current or {}).get("version", 0)
    if have != expected_version:
        raise VersionConflict(f"{state_id}: expected version {expected_version}, found {have}")
    append_claimed(next_state_row(spark, current, state_id, run_ts, jobs_added), table, state_id,
                   expected_version + 1, fmt, owner=run_id, stale_after=stale_after)
    return expected_version + 1


def claim_path(spark: SparkSession, table: str, state_id: str, version: int) -> str:
    """Where the claim of a version lies: in the database's folder, hidden from table reads."""
    database, _, name = table.rpartition(".")
    base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/_claims_{name}/{quote(state_id, safe='')}/{version}"


def _file(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of the Hadoop client."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def claim(spark: SparkSession, path: str, owner: str = "") -> None:
    """Create ``path`` with the owner's name in it, or raise ``VersionConflict`` if it is there.

    Local folders: an exclusive open.  Other stores: the Hadoop client's
    create without overwrite, which HDFS does atomically.
    """
    if path.startswith("file:") or path.startswith("/"):
        own = local_fs_path(path)
        os.makedirs(os.path.dirname(own), exist_ok=True)
        try:
            with open(own, "x", encoding="utf-8") as f:
                f.write(owner)
        except FileExistsError as e:
            raise VersionConflict(f"{path} is claimed") from e
        return
    store, there = _file(spark, path)
    try:
        out = store.create(there, False)
        out.write(bytearray(owner.encode()))
        out.close()
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise VersionConflict(f"{path} is claimed") from e
        raise


def claimed_by(spark: SparkSession, path: str) -> tuple[str, dt.datetime] | None:
    """Owner and time (UTC) of a claim, or None."""
    if path.startswith("file:") or path.startswith("/"):
        try:
            with open(local_fs_path(path), encoding="utf-8") as f:
                owner = f.read()
            seconds = os.path.getmtime(local_fs_path(path))
        except FileNotFoundError:
            return None
    else:
        store, there = _file(spark, path)
        if not store.exists(there):
            return None
        status = store.getFileStatus(there)
        stream = store.open(there)
        owner = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        stream.close()
        seconds = status.getModificationTime() / 1000
    return owner, dt.datetime.fromtimestamp(seconds, dt.timezone.utc).replace(tzinfo=None)


def release(spark: SparkSession, path: str) -> None:
    """Give up a claim whose row was not written."""
    store, there = _file(spark, path)
    store.delete(there, False)


def has_version(spark: SparkSession, table: str, state_id: str, version: int) -> bool:
    return spark.catalog.tableExists(table) and not spark.table(table).where(
        (F.col("state_id") == state_id) & (F.col("version") == version)).isEmpty()


def append_claimed(row: DataFrame, table: str, state_id: str, version: int, fmt: str = "parquet",
                   owner: str | None = None, stale_after: dt.timedelta = STALE_AFTER) -> None:
    """Append a state row under the claim of its version.

    A write that fails gives the claim up.  One whose run dies leaves it: the same owner goes
    on with it, another one takes it over once it is ``stale_after`` old and its row is
    still not there.  Of several that take it over, one creates it anew.
    """
    spark = row.sparkSession
    owner = owner or uuid.uuid4().hex
    path = claim_path(spark, table, state_id, version)
    held = claimed_by(spark, path)
    if held is not None:
        if has_version(spark, table, state_id, version):
            raise VersionConflict(f"{state_id}: version {version} is there")
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        if held[0] != owner:
            if now - held[1] < stale_after:
                raise VersionConflict(f"{path} is claimed")
            release(spark, path)
            held = None
    if held is None:
        claim(spark, path, owner)
    try:
        row.write.format(fmt).mode("append").saveAsTable(table)
    except BaseException:
        release(spark, path)
        raise
