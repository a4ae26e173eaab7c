"""Grouping helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _one_row_per_key(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ties = [c for c in rest if c not in order and _orderable(df.schema[c].dataType)]
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in ties])
    row = F.struct(*[F.col(c) for c in rest])
    best = df.groupBy(*keys).agg(pick(row, rank).alias("_row"))
    return best.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def first_row_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the lowest by ``order`` (nulls lowest).

    An aggregate rather than ``row_number``: each task reduces its rows to one per key
    before the shuffle, so a key with most of the rows costs no more than any other.
    Equal ranks are settled by the remaining columns, so a rerun picks the same row.
    """
    return _one_row_per_key(df, keys, order, F.min_by)


def last_row_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the highest by ``order`` (nulls lowest)."""
    return _one_row_per_key(df, keys, order, F.max_by)


def bucket_groups(
    df: DataFrame, value: str, bounds: list[int], aggs: list[Column], default: str = "other"
) -> DataFrame:
    """Group into ``[b_i, b_i+1)`` intervals named by their lower bound, the rest under ``default``."""
    label = F.lit(default)
    for lo, hi in reversed(list(zip(bounds, bounds[1:]))):
        label = F.when((F.col(value) >= lo) & (F.col(value) < hi), F.lit(str(lo))).otherwise(label)
    grouped = df.groupBy(label.alias("bucket")).agg(*aggs)
    return grouped.orderBy(F.expr("try_cast(bucket AS double)").asc_nulls_last(), "bucket")


def facet(
    df: DataFrame,
    branches: dict[str, Callable[[DataFrame], DataFrame]],
    path: str | None = None,
) -> DataFrame:
    """Several results over one input, stacked under a ``facet`` label.

    With ``path``, a folder in shared storage, the input is written there first and worked
    out exactly once; without it each branch plans the input anew and shares only those
    shuffles that come out the same.
    """
    if path is not None:
        df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    stacked = None
    for name, build in branches.items():
        rows = build(df).select(F.lit(name).alias("facet"), "*")
        stacked = rows if stacked is None else stacked.unionByName(rows, allowMissingColumns=True)
    return stacked


def value_counts(df: DataFrame, column: str, more_than: int = 0) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return counted.filter(F.col("rows") > more_than)


def share_of_total(
    df: DataFrame, keys: list[str], count: str = "rows", share: str = "percentage"
) -> DataFrame:
    """Rows per group and their percent of all rows, two places.

    The total is a scalar subquery over the grouped rows, so nothing meets in one task.
    """
    grouped = df.groupBy(*keys).agg(F.count("*").alias(count))
    total = grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn(
        share, F.bround((F.col(count) * 100).cast("decimal(38,10)") / total, 2).cast("double")
    )


def exact_quantiles(
    df: DataFrame, columns: list[str], shares: list[float], bins: int = 256
) -> DataFrame:
    """``column`` and ``q``: the quantiles of each column, interpolated between neighbours.

    Values are counted before the shuffle. Approximate quantiles only cut each column into
    about ``bins`` ranges; counts per range then tell the exact rank at which each range
    begins, so running counts are taken range by range and no task orders a whole column.
    """
    named = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    counted = (
        df.select(F.inline(F.array(*named)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    points = [i / bins for i in range(1, bins)]
    cuts = counted.groupBy(F.col("column").alias("_of")).agg(
        F.percentile_approx("value", points, F.lit(100 * bins)).alias("cuts")
    )
    binned = counted.join(cuts, F.col("column") == F.col("_of")).select(
        "column", "value", "n", F.size(F.filter("cuts", lambda c: c < F.col("value"))).alias("bin")
    )
    in_column = Window.partitionBy("column").orderBy("bin")
    begins = (
        binned.groupBy("column", "bin")
        .agg(F.sum("n").alias("rows"))
        .select(
            F.col("column").alias("_of"),
            F.col("bin").alias("_bin"),
            (F.sum("rows").over(in_column) - F.col("rows")).alias("begins"),
            F.sum("rows").over(Window.partitionBy("column")).alias("all"),
        )
    )
    in_bin = Window.partitionBy("column", "bin").orderBy("value")
    ranked = binned.join(begins, (F.col("column") == F.col("_of")) & (F.col("bin") == F.col("_bin"))).select(
        "column", "value", "n", "all", (F.col("begins") + F.sum("n").over(in_bin)).alias("upto")
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")), F.col("value")))

    places = [(F.col("all") - 1) * share for share in shares]
    ends = [at(end).alias(f"_{i}_{side}") for i, p in enumerate(places) for side, end in (("lo", F.floor(p)), ("hi", F.ceil(p)))]
    found = ranked.groupBy("column", "all").agg(*ends)
    values = [
        F.col(f"_{i}_lo") + (F.col(f"_{i}_hi") - F.col(f"_{i}_lo")) * (p - F.floor(p))
        for i, p in enumerate(places)
    ]
    return found.select("column", F.array(*values).alias("q"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of numeric columns, one row each."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev_samp(F.col(c).cast("double")).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in columns
    ]
    moments = df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
    return moments.join(exact_quantiles(df, columns, [0.25, 0.5, 0.75]), "column", "left").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
        "max",
    )


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types: schema only, no job."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def labelled_union(frames: dict[str, DataFrame], label: str = "kind") -> DataFrame:
    """UNION ALL with a column that tells which input a row is from."""
    stacked = None
    for name, frame in frames.items():
        rows = frame.select(F.lit(name).alias(label), "*")
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked


def sorted_set(column: str) -> Column:
    """Distinct values in order, nulls left out. For columns of a small value domain."""
    return F.array_sort(F.collect_set(column))
