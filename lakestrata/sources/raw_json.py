"""Landed JSON sources.

Every reader takes an explicit schema; inference is only the ``landing``
mode of S1.  Multi-line JSON is one task per file (unsplittable), so raw
landing should be many moderate files; from silver on, data is Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..schemas import CORRUPT_COLUMN, DAILY_RESPONSE, HOURLY_RESPONSE, JOB_PAGE


# Full microsecond precision on write (the writer's default drops to millis);
# the reader's default ISO parser reads it back exactly.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_json(df: DataFrame, path: str, partition_by: list[str] | None = None,
               mode: str = "errorifexists") -> None:
    """JSON-lines landing with lossless timestamps."""
    w = (df.write.mode(mode).option("timestampFormat", TS_FORMAT)
         .option("timestampNTZFormat", TS_NTZ_FORMAT))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.json(path)


def land_json_arrays(df: DataFrame, path: str, n_files: int, compression: str = "gzip") -> None:
    """Land ``df`` as ``n_files`` multi-line JSON files, each one JSON array,
    under ``path/bucket=<i>/`` (the two-level layout raw drops use).

    Rows are spread by position (a hash of ``monotonically_increasing_id``,
    stable for a given input split), not by any key: each collected file
    body holds about ``rows / n_files`` rows even when one key or one
    repeated row is a third of the data.  ``n_files`` must grow with the
    data.  A multi-line file is read by one task in any case, so the bodies
    are compressed (``*.txt.gz``): JSON text is several times as large as its rows."""
    bucket = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_files))
    bodies = (df.withColumn("bucket", bucket)
              .groupBy("bucket")
              .agg(F.to_json(F.collect_list(F.struct(*[F.col(c) for c in df.columns])),
                             {"timestampNTZFormat": TS_NTZ_FORMAT, "timestampFormat": TS_FORMAT})
                   .alias("value")))
    bodies.write.partitionBy("bucket").option("compression", compression).text(path)


def read_raw_json(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
                  multi_line: bool = True, corrupt_column: str = CORRUPT_COLUMN) -> DataFrame:
    """JSON files (glob allowed, e.g. ``films/*/*.json``); a file may hold
    one object or an array of them.  A malformed record becomes one row with
    only ``corrupt_column`` set (PERMISSIVE); no match raises PATH_NOT_FOUND.

    With ``schema=None`` the schema is inferred (landing mode); otherwise the
    corrupt column is added to the schema if missing, so a bad file is never a
    silent all-null row.
    """
    reader = (spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt_column))
    if schema is not None:
        if corrupt_column not in schema.fieldNames():
            # a new field list: StructType.add would append to the caller's list
            schema = StructType(list(schema.fields) + [StructField(corrupt_column, StringType())])
        reader = reader.schema(schema)
    return reader.json(path)


def split_corrupt(df: DataFrame, corrupt_column: str = CORRUPT_COLUMN) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined raw records)."""
    if corrupt_column not in df.columns:
        return df, df.where(F.lit(False))   # no corrupt column: nothing quarantined
    good = df.where(F.col(corrupt_column).isNull()).drop(corrupt_column)
    bad = df.where(F.col(corrupt_column).isNotNull())
    return good, bad


def read_job_pages(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Landed API pages ``{"results": [...]}``, one page per record; no files give no rows
    (with the metadata that the files' rows would have)."""
    if isinstance(path, list) and not path:
        meta = StructType([StructField("file_path", StringType()),
                           StructField("file_modification_time", TimestampType())])
        return spark.createDataFrame([], StructType([*JOB_PAGE.fields, StructField("_metadata", meta)]))
    return read_raw_json(spark, path, JOB_PAGE, multi_line=multi_line)


def read_weather_responses(spark: SparkSession, path: str, hourly: bool = False,
                           multi_line: bool = True,
                           extra_fields: list[StructField] | None = None) -> DataFrame:
    """Landed daily or hourly responses; the source file is kept as
    the response id (``_metadata.file_path``).  ``extra_fields`` declares
    fields a landing adds to each response (e.g. a site id)."""
    schema = HOURLY_RESPONSE if hourly else DAILY_RESPONSE
    if extra_fields:
        schema = StructType(list(schema.fields) + list(extra_fields))
    df = read_raw_json(spark, path, schema, multi_line=multi_line)
    return df.withColumn("response_id", F.col("_metadata.file_path"))


def read_partitioned_tree(spark: SparkSession, base: str, schema: StructType,
                          fmt: str = "json", multi_line: bool = True) -> DataFrame:
    """A Hive-style ``year=/month=[/day=/hour=]`` tree.  Reading from the
    base path keeps the partition columns; a filter on them prunes
    directories (``PartitionFilters``).  Pretty-printed JSON must be read
    multi-line.  The schema names the partition columns' types, so
    ``month=01`` is read as declared."""
    r = spark.read.format(fmt).schema(schema).option("basePath", base)
    if fmt == "json":
        r = r.option("multiLine", multi_line)
    return r.load(base)
