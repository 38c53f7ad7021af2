"""Ledger of landed files: what was read, when, and with what outcome.

One row a landing, file, state (time and size) and run.  A run lists the landing and
anti joins the listing with the ledger before any record is parsed, so it
opens only files that are new or changed.  A file with malformed records is
entered as ``quarantined`` with the start of the window that it was read for; it is not read again
as it is.  Once it has changed or gone, the next files that land are taken to
hold its records: they are read for its window, whatever the state has reached
by then, and the bad state is entered as ``replaced``.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import ts_lit
from .tables import table_exists

LOADED, QUARANTINED, REPLACED = "loaded", "quarantined", "replaced"
LEDGER = T.StructType([
    T.StructField("landing", T.StringType()), T.StructField("file", T.StringType()), T.StructField("modified", T.TimestampType()),
    T.StructField("bytes", T.LongType()), T.StructField("outcome", T.StringType()),
    T.StructField("window_start", T.TimestampNTZType()), T.StructField("run_ts", T.TimestampNTZType())])
STATE = ["file", "modified", "bytes"]


def listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, path, modified, bytes) of the files under ``path``: the listing only, no file is opened."""
    meta = {"file": "file_path", "modified": "file_modification_time", "bytes": "file_size"}
    return spark.read.format("binaryFile").load(path).select(
        "path", *[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()])


def entries(spark: SparkSession, name: str, landing: str) -> DataFrame:
    """What the ledger has of one landing: each is read by itself."""
    if table_exists(spark, name):
        return spark.table(name).where(F.col("landing") == landing)
    return spark.createDataFrame([], LEDGER)


def fresh(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listed files that the ledger does not have in their present state."""
    return files.join(ledger.select(*STATE).distinct(), STATE, "left_anti")


def open_bad(ledger: DataFrame) -> DataFrame:
    """(file, modified, bytes, window_start) of the quarantined states that nothing has replaced yet."""
    done = ledger.where(F.col("outcome") == REPLACED).select(*STATE).distinct()
    return (ledger.where(F.col("outcome") == QUARANTINED).groupBy(*STATE).agg(F.min("window_start").alias("window_start"))
            .join(done, STATE, "left_anti"))


def still_bad(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The listed files that are quarantined in their present state."""
    return files.join(open_bad(ledger), STATE, "left_semi")


def gone_bad(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """The quarantined states that are no longer landed: the file has changed or gone."""
    return open_bad(ledger).join(files, STATE, "left_anti")


def paths(files: DataFrame) -> list[str]:
    """The files' paths, for a reader: as many as the run has new files, which the reader's own
    file index holds on the driver as well.  Signs that readers take for patterns are escaped."""
    return sorted(re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in files.select("path").toLocalIterator())


def enter(files: DataFrame, bad_files: DataFrame, replaced: DataFrame, name: str, landing: str,
          window_start: dt.datetime, run_ts: dt.datetime, fmt: str = "parquet") -> None:
    """Enter the files that a run has read for a window, of which ``bad_files`` (file) had malformed records,
    and the bad states that they replace."""
    bad = bad_files.select("file", F.lit(True).alias("bad")).distinct()
    rows = files.join(bad, "file", "left").select(
        *STATE, F.when(F.col("bad"), F.lit(QUARANTINED)).otherwise(F.lit(LOADED)).alias("outcome"))
    rows = rows.unionByName(replaced.select(*STATE, F.lit(REPLACED).alias("outcome")))
    rows.select(F.lit(landing).alias("landing"), "*", ts_lit(window_start).alias("window_start"), ts_lit(run_ts).alias("run_ts")
                ).write.format(fmt).mode("append").saveAsTable(name)
