"""T2 with bounded state: duplicates known by the state store, late rows kept in a side table.

``append_new_batch`` knows every id for ever, from the stored table.  Here the
state store knows the ids of the last ``overlap`` only (the window that
each run fetches again), so its size follows the arrival rate and not the
history; nothing stored is read.  What the operator would drop as too late never
reaches it: rows at or below the watermark that the checkpoint has reached go to the
side table in the same query, so one checkpoint covers both and no row is lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

OUTCOME = "outcome"
STORED, LATE = "stored", "late"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class DedupRun:
    """What a run did: rows read, ids that the state store holds after it, the watermark that it started from."""

    rows: int
    state_rows: int
    watermark_ms: int


class LateRowsDropped(RuntimeError):
    """The stateful operator has dropped rows that should have gone to the side table."""


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def reached(spark: SparkSession, checkpoint: str) -> int:
    """The watermark (ms since 1970) that the committed batches of a checkpoint have reached; 0 before the first one."""
    try:
        lines = spark.read.text(f"{checkpoint}/commits")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
    mark = F.get_json_object("value", "$.nextBatchWatermarkMs").cast("long")
    return int(lines.select(F.max(mark).alias("ms")).first()["ms"] or 0)


def is_late(ts: str, watermark_ms: int) -> Column:
    """Whether a row lies at or below the watermark, or has no time."""
    if watermark_ms <= 0:
        return F.col(ts).isNull()
    return F.coalesce(F.col(ts).cast("timestamp") <= F.timestamp_millis(F.lit(watermark_ms)), F.lit(True))


def dedup_run(stream: DataFrame, checkpoint: str, sink: str, key: str, ts: str, overlap: str,
              fmt: str = "parquet") -> DedupRun:
    """One scheduled run (T3): all that has landed, one row a ``key``, then stop.

    ``stream`` comes from a source without a rate limit (``file_stream`` without
    ``max_files_per_trigger``): a run is one batch, so the watermark doesn't move within it.
    ``sink`` gets the rows in two folders: ``outcome=stored`` and ``outcome=late``
    (``stored_rows``, ``late_rows``).

    Cases: the first arrival of a key stays while the watermark, ``overlap`` behind the
    latest time seen, has not passed its time by another ``overlap``; after that the key
    is new again (keep ``append_new_batch`` where ids return after long times).  Of several rows of one run
    with one key any one stays.  Rows without a key are all stored; rows without a
    time and rows at or below the watermark are all late, duplicates among them included.
    A run that died is repeated by the next one from the same watermark.
    """
    spark = stream.sparkSession
    if not re.match(r"\d+ (second|minute|hour|day)s?\Z", overlap):
        raise ValueError(f"overlap must be a number of seconds, minutes, hours or days: {overlap!r}")
    if OUTCOME in stream.columns or "_event" in stream.columns:
        raise ValueError(f"the stream already has a column {OUTCOME} or _event")
    start = reached(spark, checkpoint)
    late, keyed = is_late(ts, start), F.col(key).isNotNull()
    known = (stream.where(keyed & ~late).withColumn("_event", F.col(ts).cast("timestamp"))
             .withWatermark("_event", overlap).dropDuplicatesWithinWatermark([key]).drop("_event"))
    out = known.withColumn(OUTCOME, F.lit(STORED)).unionByName(
        stream.where(~keyed | late).withColumn(OUTCOME, F.when(late, LATE).otherwise(STORED)))
    with _setting(spark, PROVIDER, ROCKSDB):
        query = (out.writeStream.format(fmt).outputMode("append").option("path", sink).partitionBy(OUTCOME)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    progress = query.recentProgress
    operators = [s for p in progress for s in p.stateOperators]
    dropped = sum(s.numRowsDroppedByWatermark for s in operators)
    if dropped:
        raise LateRowsDropped(f"{dropped} rows; was the source rate-limited?")
    return DedupRun(sum(int(p.numInputRows) for p in progress), int(operators[-1].numRowsTotal) if operators else 0, start)


def stored_rows(spark: SparkSession, sink: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The rows kept, one a key; only their folder is read."""
    return _read(spark, sink, schema, fmt).where(F.col(OUTCOME) == STORED).drop(OUTCOME)


def late_rows(spark: SparkSession, sink: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The side table: what came after the watermark."""
    return _read(spark, sink, schema, fmt).where(F.col(OUTCOME) == LATE).drop(OUTCOME)


def _read(spark: SparkSession, sink: str, schema: StructType, fmt: str) -> DataFrame:
    return spark.read.format(fmt).schema(StructType([*schema.fields, StructField(OUTCOME, StringType())])).load(sink)
