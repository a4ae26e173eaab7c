"""Time-range scans over partitioned and time-sorted tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.predicates import time_range

# How a bucket key is written for each unit.
BUCKET_FORMATS = {"year": "yyyy", "month": "yyyy_MM"}
_PYTHON_FORMATS = {"year": "%Y", "month": "%Y_%m"}


def scan_range(
    spark: SparkSession,
    path: str,
    ts: str,
    lo: str,
    hi: str,
    unit: str,
    table_lo: str,
    table_hi: str,
    part: str = "part",
) -> DataFrame:
    """Rows with ``lo <= ts < hi`` from a table laid out by ``sinks.layout``.

    The filter names the bucket column as well, so only matching folders are listed.
    The default bucket is read only if the range reaches outside the table's bounds.
    """
    fmt = _PYTHON_FORMATS[unit]
    first = dt.datetime.fromisoformat(lo)
    last = dt.datetime.fromisoformat(hi) - dt.timedelta(microseconds=1)
    inside = F.col(part).between(first.strftime(fmt), last.strftime(fmt))
    reaches_out = first < dt.datetime.fromisoformat(table_lo) or dt.datetime.fromisoformat(
        hi
    ) > dt.datetime.fromisoformat(table_hi)
    buckets = inside | (F.col(part) == "default") if reaches_out else inside
    return read_partitioned(spark, path, part).filter(buckets & time_range(F.col(ts), lo, hi))


def read_partitioned(spark: SparkSession, path: str, part: str = "part") -> DataFrame:
    """The whole table; the bucket column is kept as text (``2017``, ``default``)."""
    files = spark.read.parquet(path)
    return files.withColumn(part, F.col(part).cast("string"))


def scan_sorted_range(spark: SparkSession, path: str, ts: str, lo: str, hi: str) -> DataFrame:
    """The same rows from a time-sorted copy, where Parquet skips blocks by min and max."""
    return spark.read.parquet(path).filter(time_range(F.col(ts), lo, hi))


def read_by_id(spark: SparkSession, path: str, schema: str, column: str, value, buckets: int) -> DataFrame:
    """Rows of one id from a copy written by ``layout.write_by_id`` with that many buckets: one folder is opened."""
    table = spark.read.schema(f"{schema}, id_bucket int").parquet(path)
    wanted = F.lit(value).cast(table.schema[column].dataType)
    of_id = F.pmod(F.xxhash64(wanted), F.lit(buckets)).cast("int")
    return table.filter((F.col("id_bucket") == of_id) & (F.col(column) == wanted)).drop("id_bucket")
