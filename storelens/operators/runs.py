"""Ordered work without one task per key: ranges, their summaries, and what is carried over their edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelens.session import fresh_path

RUN = "_run"


def sorted_runs(df: DataFrame, order: list[str], label: str = "runs") -> DataFrame:
    """``df`` dealt to ranges by ``order`` (nulls first) and written once; ``_run`` numbers the ranges in that order.

    Rows equal in ``order`` share a range, so end it in a key: a busy value is then cut into several ranges. Whatever
    depends on all earlier rows is worked out per range, summed over the few rows that describe ranges, and added
    to the rows of each range.
    """
    path = fresh_path(df.sparkSession, label)
    dealt = df.repartitionByRange(*order).withColumn(RUN, F.spark_partition_id())
    dealt.write.parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def spread_join(many: DataFrame, one: DataFrame, on: list[str], salt: str, how: str = "left", shuffled: bool = False) -> DataFrame:
    """``many`` joined with ``one``, which has a row per key; rows of a hot key meet in as many tasks as ``salt`` has values.

    The distinct (key, salt) are joined with ``one`` first; with map-side combining they are at most one row per salt and key.
    Keys must not be null in rows that are to match. With ``shuffled`` neither join is left to a broadcast, which the driver would collect.
    """
    plain = (lambda df: df.hint("merge")) if shuffled else (lambda df: df)
    keys = many.select(*on, salt).distinct().join(plain(one), on, how)
    extra = [c for c in one.columns if c not in on]
    right = keys.select(*(F.col(c).alias(f"_k_{c}") for c in [*on, salt]), *extra)
    match = [many[c] == right[f"_k_{c}"] for c in [*on, salt]]
    return many.join(plain(right), match, how).select(*many.columns, *extra)


def numbered(df: DataFrame, order: list[str], name: str, label: str = "numbered") -> DataFrame:
    """Rows numbered 1 to N by ``order``: each range numbers its own and begins where those before it end."""
    runs = sorted_runs(df, order, label)
    sizes = runs.groupBy(RUN).agg(F.count("*").alias("_n"))
    before = Window.orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select(F.col(RUN).alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(RUN).orderBy(*order))
    placed = runs.withColumn("_place", place).join(starts, F.col(RUN) == F.col("_of"))
    return placed.withColumn(name, (F.col("_start") + F.col("_place")).cast("bigint")).drop(RUN, "_of", "_start", "_place")
