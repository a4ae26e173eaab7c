"""Tables in time buckets that change in place: only the buckets that a change touches are rewritten.

``root/rows`` holds the rows in one folder per bucket, ``root/keys`` says in which bucket each key is, in
``slots`` folders by the key's hash. An update reads the slots of its own keys, the buckets
they are in, and the buckets they go to; every other file stays as it is.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators.aggregates import last_row_per_key
from storelens.session import file_sized, fresh_path
from storelens.sinks.layout import range_bucket
from storelens.sinks.upserts import upsert


@dataclass(frozen=True)
class BucketTable:
    """Where the table is and how it is dealt: months (or another unit) of ``ts`` within ``[lo, hi)``, else ``default``."""

    root: str
    schema: str
    keys: tuple[str, ...]
    ts: str
    lo: str
    hi: str
    unit: str = "month"
    slots: int = 64

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows, with their bucket in ``part``."""
        return spark.read.schema(f"{self.schema}, part string").parquet(f"{self.root}/rows")

    def places(self, spark: SparkSession) -> DataFrame:
        """``keys`` and ``part`` of every row, in folders by ``slot``."""
        names = spark.createDataFrame([], self.schema).select(*self.keys).schema
        return spark.read.schema(names.add("part", "string").add("slot", "integer")).parquet(f"{self.root}/keys")

    def bucket(self) -> Column:
        return range_bucket(F.col(self.ts), self.unit, self.lo, self.hi)

    def slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.slots)).cast("int")


def create(df: DataFrame, table: BucketTable) -> None:
    """Write the rows and the map of their keys. Keys must be distinct; null counts as a value."""
    dealt = df.withColumn("part", table.bucket())
    _overwrite(dealt, f"{table.root}/rows", ["part"])
    _overwrite(dealt.select(*table.keys, "part").withColumn("slot", table.slot()), f"{table.root}/keys", ["slot"])


def merge(
    spark: SparkSession, table: BucketTable, updates: DataFrame, order: list[str], keep_when_null: bool = False, stamp: tuple[str, Column] | None = None
) -> list[str]:
    """Set the updates' columns on rows with their key and add the others; the buckets rewritten.

    As ``upserts.upsert``: the last update of a key by ``order`` counts, null keys are equal, columns that an update lacks keep their
    value. A row whose time changes leaves its bucket. The new content of all touched buckets
    is written elsewhere before the first is replaced, so a failed run can be repeated.
    """
    newest = last_row_per_key(updates, list(table.keys), order).withColumn("_slot", table.slot())
    newest = _kept(newest, "merge-updates")
    slots = [r[0] for r in newest.select("_slot").distinct().collect()]  # at most ``table.slots``
    if not slots:
        return []
    hit = _with_keys(newest.select(*table.keys), "_u")
    known = _kept(_semi(table.places(spark).filter(F.col("slot").isin(slots)), hit, table.keys, "left_semi"), "merge-places")
    left = [r[0] for r in known.select("part").distinct().collect()]  # buckets, as many as the table has at most
    before = table.rows(spark).filter(F.col("part").isin(left))
    changed = upsert(
        _semi(before, hit, table.keys, "left_semi").drop("part"), newest.drop("_slot"), list(table.keys), order, keep_when_null, stamp
    )
    names = [c for c in table.rows(spark).columns if c != "part"]
    changed = _kept(changed.select(*names).withColumn("part", table.bucket()), "merge-changed")
    entered = [r[0] for r in changed.select("part").distinct().collect()]
    touched = sorted({*left, *entered})
    stay = _semi(table.rows(spark).filter(F.col("part").isin(touched)), hit, table.keys, "left_anti")
    after = _kept(stay.unionByName(changed), "merge-rows")
    others = _semi(table.places(spark).filter(F.col("slot").isin(slots)), hit, table.keys, "left_anti")
    places = _kept(others.unionByName(changed.select(*table.keys, "part").withColumn("slot", table.slot())), "merge-keys")
    _overwrite(after, f"{table.root}/rows", ["part"])
    filled = {r[0] for r in after.select("part").distinct().collect()}
    for part in touched:
        if part not in filled:
            # a bucket without rows is not among those written: its folder gets an empty file
            after.drop("part").limit(0).write.mode("overwrite").parquet(f"{table.root}/rows/part={part}")
    _overwrite(places, f"{table.root}/keys", ["slot"])
    return touched


def _overwrite(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the folders that ``df`` has rows for, and no others."""
    with file_sized(df.sparkSession):
        df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _with_keys(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{prefix}{c}") for c in df.columns))


def _semi(df: DataFrame, hit: DataFrame, keys: tuple[str, ...], how: str) -> DataFrame:
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_u{k}")) for k in keys])
    return df.join(hit, on, how)


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
