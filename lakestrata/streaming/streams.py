"""Structured Streaming forms of the incremental loads.

The source system kept a high-water mark and re-read a 12 h overlap; here
the file source's checkpoint remembers which files were processed, the stored
table remembers every id for ever (no watermark, so no row is ever too late), and
``trigger(availableNow=True)`` makes each scheduled run process exactly
what has landed since the last one, then stop.  All state (offsets,
commits, dedup keys) lives in the checkpoint folder, so a lost executor or
a restarted run resumes where the last committed batch ended.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import ts_lit
from ..operators.dedup import dedup_first
from ..operators.state import (append_claimed, claim_path, claimed_by, current_state, has_version,
                               next_state_row)
from ..sources import held, tables


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """T1 source: new files under ``path`` (explicit schema, optional glob)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_available_now(df: DataFrame, checkpoint: str, *, sink_path: str | None = None,
                      fmt: str = "parquet", partition_by: list[str] | None = None,
                      foreach_batch: Callable[[DataFrame, int], None] | None = None,
                      name: str | None = None) -> int:
    """Run a stream until everything landed so far is processed, then stop
    (T1/T3: any outside scheduler runs this once per period).  Returns the
    number of input rows processed in this run."""
    w = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).outputMode("append").option("path", sink_path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return sum(int(p.get("numInputRows", 0)) for p in q.recentProgress)


def merge_hours_batch(path: str, partition_by: list[str], key: list[str],
                      transform: Callable[[DataFrame], DataFrame] | None = None,
                      latest: list[str] | None = None,
                      fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """T4: a ``foreachBatch`` function that replaces the stored records with
    the keys of each micro-batch.  An hour may come in several batches, and a
    replayed batch writes the same records again."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        tables.merge_partitions(rows, path, partition_by, key, latest=latest, fmt=fmt)
    return fn


def versioned_state_batch(state_table: str, state_id: str, ts: str, stream_id: str,
                          fmt: str = "parquet",
                          clock: Callable[[], dt.datetime] | None = None) -> Callable[[DataFrame, int], None]:
    """T5: a ``foreachBatch`` function committing one control-table row per
    micro-batch.

    ``stream_id`` names the checkpoint: batch ids start anew with a new one.
    The version that a batch is going to commit is logged under (stream id, batch
    id) first, and its claim carries that name.  A replayed batch finds its entry: if
    the claim is its own and the row is there, it is done; if the run died in
    between, it goes on under its claim; if another run has taken the version,
    it takes the next one.
    ``clock`` gives created_at / updated_at (default: now, UTC); the
    high-water mark is the batch's greatest ``ts`` and never falls.
    """
    log = f"{state_table}_batches"

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        owner = f"{stream_id}#{batch_id}"
        entries = []
        if spark.catalog.tableExists(log):
            entries = [r["version"] for r in spark.table(log).where(
                (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)).select("version").distinct().collect()]
        for version in entries:                             # one, and one more for each time that another run was first
            mine = claimed_by(spark, claim_path(spark, state_table, state_id, version))
            if mine is not None and mine[0] == owner and has_version(spark, state_table, state_id, version):
                return  # replay of a committed batch
        current = None
        if spark.catalog.tableExists(state_table):
            rows = current_state(spark.table(state_table).where(F.col("state_id") == state_id)).collect()
            current = rows[0].asDict() if rows else None
        version = (current or {}).get("version", 0) + 1
        if version not in entries:
            spark.createDataFrame([(stream_id, batch_id, version)], "stream_id string, batch_id long, version long"
                                  ).write.format(fmt).mode("append").saveAsTable(log)
        stats = batch.agg(F.count(F.lit(1)).alias("n"), F.max(ts).alias("hw")).first()
        known = (current or {}).get("last_extraction_time")
        mark = max([x for x in (known, stats["hw"]) if x is not None], default=None)
        now = (clock or (lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)))()
        append_claimed(next_state_row(spark, current, state_id, mark, int(stats["n"]), updated_at=now),
                       state_table, state_id, version, fmt, owner=owner)
    return fn


def append_new_batch(table: str, key: str, partition_by: list[str],
                     audit: Callable[[DataFrame], DataFrame] | None = None,
                     fmt: str = "parquet",
                     bucket_by: tuple[int, str] | None = None,
                     ts: str | None = None,
                     run_ts: dt.datetime | None = None) -> Callable[[DataFrame, int], None]:
    """T2 + J1 in ``foreachBatch``: one row per id within the micro-batch
    (the latest ``ts``), none whose id is stored: a replayed batch adds
    nothing and the stream ends where the batch load (C7) ends.

    With ``ts`` and ``run_ts``, rows dated after the run (F1) wait by day beside the table
    (``sources.held``), all versions of them, and are taken up by the first run that
    reaches them: the latest version is stored.  Days that are over are cleared.
    Rows that arrive late are stored like any other.
    """
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, path = batch, None
        if ts and run_ts is not None:
            path = held.folder(spark, table)
            early = F.col(ts) > ts_lit(run_ts)
            later = batch.where(early)
            if not later.isEmpty():
                held.hold(later, path, ts, fmt=fmt)
            rows = batch.where(~early | F.col(ts).isNull())
            reached = held.waiting(spark, path, batch.schema, ts, run_ts, fmt=fmt)
            if reached is not None:
                rows = rows.unionByName(reached)
        if ts:
            rows = dedup_first(rows, [key], [(ts, "desc"), *[c for c in rows.columns if c not in (key, ts)]])
        rows = audit(rows) if audit else rows
        tables.append_new(rows, table, key, partition_by=partition_by, fmt=fmt,
                          bucket_by=bucket_by)
        if path is not None:
            held.clear(spark, path, run_ts)
    return fn
