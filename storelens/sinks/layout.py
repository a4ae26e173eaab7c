"""Range buckets, sorted copies, saved subsets and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.predicates import instant, time_range
from storelens.session import file_sized
from storelens.sources.scans import BUCKET_FORMATS


def range_bucket(ts: Column, unit: str, lo: str, hi: str) -> Column:
    """Bucket key of a time; anything outside ``[lo, hi)``, and null, goes to ``default``."""
    return F.when(time_range(ts, lo, hi), F.date_format(ts, BUCKET_FORMATS[unit])).otherwise(
        F.lit("default")
    )


def write_partitioned(
    df: DataFrame, path: str, ts: str, unit: str, lo: str, hi: str, part: str = "part"
) -> None:
    """One folder per bucket.

    The rebalance hint brings a bucket's rows together, so there are few files each,
    and adaptive execution cuts a bucket that holds far more rows than the others
    into several tasks of the advisory size.
    """
    dealt = df.withColumn(part, range_bucket(F.col(ts), unit, lo, hi)).hint("rebalance", part)
    with file_sized(df.sparkSession):
        dealt.write.mode("overwrite").partitionBy(part).parquet(path)


def copy_into_partitioned(
    df: DataFrame, columns: list[str], path: str, ts: str, unit: str, lo: str, hi: str
) -> None:
    """Flat table into the bucketed one, with an explicit column list."""
    write_partitioned(df.select(*columns), path, ts, unit, lo, hi)


def write_sorted(df: DataFrame, path: str, columns: list[str], rows_per_range: int = 5_000_000) -> None:
    """A copy sorted by the columns, so block statistics are narrow.

    End the list with a key: a range boundary can then fall inside one repeated time
    value, and no task gets all rows of a popular instant. Where the session's number of shuffle partitions would make
    ranges of more than ``rows_per_range`` rows, there are as many as the rows ask for; to know, they are
    counted, which for Parquet reads footers alone.
    """
    ranges = -(-df.count() // rows_per_range)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *columns) if ranges > usual else df.repartitionByRange(*columns)
    dealt.sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def id_bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def write_by_id(df: DataFrame, path: str, column: str, buckets: int) -> None:
    """A copy for lookups by id: folders by the id's hash, sorted by id, with a bloom filter of ids in each row group.

    ``scans.read_by_id`` then opens one folder; within it row groups without the id are skipped.
    """
    dealt = df.withColumn("id_bucket", id_bucket(F.col(column), buckets))
    with file_sized(df.sparkSession):
        dealt.hint("rebalance", "id_bucket").sortWithinPartitions("id_bucket", column).write.mode("overwrite").option(
            f"parquet.bloom.filter.enabled#{column}", "true"
        ).option("parquet.bloom.filter.adaptive.enabled", "true").partitionBy("id_bucket").parquet(path)


def materialize_subset(df: DataFrame, keep: Column, order: list[str], path: str) -> None:
    """A small, often-read slice kept as its own sorted table."""
    write_sorted(df.filter(keep), path, order)


def reload(df: DataFrame, path: str) -> None:
    """Replace the whole target. ``path`` must not be among the inputs of ``df``."""
    df.write.mode("overwrite").parquet(path)


def refresh_summary(df: DataFrame, path: str, part: str | None = None) -> None:
    """Rebuild a saved summary; with ``part``, only the partitions present in ``df``."""
    writer = df.write.mode("overwrite")
    if part:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(part)
    writer.parquet(path)


def apply_retention(df: DataFrame, ts: str, months: int, as_of: str) -> DataFrame:
    """Keep the last ``months`` months, counted back from ``as_of``; undated rows stay."""
    limit = F.add_months(instant(as_of).cast("date"), -months)
    recent = F.col(ts) >= limit.cast(df.schema[ts].dataType)
    return df.filter(recent | F.col(ts).isNull())


def drop_old_partitions(
    spark: SparkSession, path: str, months: int, as_of: str, unit: str = "month", part: str = "part"
) -> DataFrame:
    """Retention on the bucket column alone: whole folders are left out, no file is opened.

    The default bucket has no place on the time line and is always kept.
    """
    limit = F.date_format(
        F.add_months(instant(as_of).cast("date"), -months), BUCKET_FORMATS[unit]
    )
    table = spark.read.parquet(path).withColumn(part, F.col(part).cast("string"))
    return table.filter((F.col(part) >= limit) | (F.col(part) == "default"))


def delete_old_partitions(
    spark: SparkSession, path: str, months: int, as_of: str, unit: str = "month", part: str = "part"
) -> list[str]:
    """Remove the bucket folders that ``drop_old_partitions`` leaves out; their names.

    Only folders directly under ``path`` are looked at; the default bucket stays. Do it when
    nothing reads the table, as readers that have listed its files would miss them.
    """
    limit = spark.range(1).select(
        F.date_format(F.add_months(instant(as_of).cast("date"), -months), BUCKET_FORMATS[unit])
    ).first()[0]
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for folder in files.listStatus(root):
        name, _, value = folder.getPath().getName().partition("=")
        if folder.isDirectory() and name == part and value != "default" and value < limit:
            files.delete(folder.getPath(), True)
            gone.append(value)
    return sorted(gone)


def fill_point(df: DataFrame, point: Column, name: str = "geo_point") -> DataFrame:
    """Add the derived point; rows without coordinates get null."""
    return df.withColumn(name, point)


def write_report(df: DataFrame, path: str) -> None:
    """A finished report as CSV files, each with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
