"""Columns and sessions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.session import configure, fresh_path

LAST_ID = (1 << 63) - 1


#: bytes of an Arrow batch; both sides of the pipe to a Python worker hold about two of them, a worker works on slices of half of one
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches are cut by their bytes, as 10,000 long texts would be one of hundreds of MB."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query that runs within go when it ends, not when the driver happens to collect its garbage.

    For frames that are executed once: what is executed again would have to be computed again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(configure(spark)).read.parquet(f"{sf_dir}/documents.parquet")


def id_or_last(name: str = "doc_id") -> Column:
    """The id, with a null id after every other."""
    return F.coalesce(F.col(name).cast("bigint"), F.lit(LAST_ID))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_key(name: str = "text") -> Column:
    """64 bits of the text: with the id it names a row up to exact repeats."""
    return F.xxhash64(text_or_empty(name))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the folder that all executors share, and read back."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
