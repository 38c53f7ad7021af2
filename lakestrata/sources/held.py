"""Rows dated after the run that brought them: kept by day until a run reaches them.

Every version of a row is held, none is chosen before its time.  A run takes
up what its clock has reached; the choice between versions is made then, like
that between the versions of one batch.  A day's folder goes once a run has passed
the whole day: until then its rows are taken up again by every run, which the
insert-if-new load makes harmless, and so does a crash between load and clearing.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..functions.scalars import ts_lit
from .tables import stored_rows

DAY = "held_day"


def folder(spark: SparkSession, table: str, source: str = "") -> str:
    """Where the held rows of a table from one source lie: beside the table, in its database's folder."""
    database, _, name = table.rpartition(".")
    base = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{base.rstrip('/')}/_held_{name}/{hashlib.sha256(source.encode()).hexdigest()[:16]}"


def hold(rows: DataFrame, path: str, ts: str, fmt: str = "parquet") -> None:
    """Keep rows (all of them dated after the run) until their day."""
    rows.withColumn(DAY, F.to_date(ts)).write.format(fmt).mode("append").partitionBy(DAY).save(path)


def waiting(spark: SparkSession, path: str, schema: StructType, ts: str, until: dt.datetime,
            fmt: str = "parquet") -> DataFrame | None:
    """The held rows that the clock has reached; only their days are read."""
    rows = stored_rows(spark, path, StructType([*schema.fields, StructField(DAY, DateType())]), fmt)
    if rows is None:
        return None
    return rows.where((F.col(DAY) <= F.lit(until.date())) & (F.col(ts) <= ts_lit(until))).drop(DAY)


def clear(spark: SparkSession, path: str, until: dt.datetime) -> list[str]:
    """Remove the days that are over; their names.  Call it after the load of what was taken up."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    store = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    if store.exists(top):
        for status in store.listStatus(top):
            name = status.getPath().getName()
            if name.startswith(f"{DAY}=") and name.removeprefix(f"{DAY}=") < until.date().isoformat():
                store.delete(status.getPath(), True)
                gone.append(name.removeprefix(f"{DAY}="))
    return sorted(gone)
