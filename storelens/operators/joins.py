"""Joins beyond the plain ones. No broadcast is forced anywhere: Spark decides by size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.operators.aggregates import last_row_per_key


def lookup(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, as_: str, buckets: int
) -> DataFrame:
    """Matching right rows as an array per left row, empty if there are none.

    Every left row gives ``buckets`` rows, numbered by ``chunk``, whatever the size of the data; a
    match is in one of them, by its hash. With 1 all matches of a key meet in
    one array, so the number is the caller's to declare: as many as keep the most crowded key's arrays small;
    or ``lookup_unwound`` if the joined rows are enough. Equal right rows are counted before the shuffle and dealt
    over the buckets in turn.
    """
    names = right.columns
    copies = right.filter(F.col(right_key).isNotNull()).groupBy(*names).agg(
        F.count("*").alias("_copies")
    )
    turn = F.explode(F.sequence(F.lit(0), F.least(F.lit(buckets), F.col("_copies")).cast("int") - 1))
    pieces = copies.withColumn("_turn", turn).withColumns(
        {
            "_chunk": F.pmod(F.xxhash64(*names) + F.col("_turn"), F.lit(buckets)).cast("int"),
            "_times": F.floor((F.col("_copies") - F.col("_turn") - 1) / buckets).cast("int") + 1,
        }
    )
    arrays = pieces.groupBy(F.col(right_key).alias("_lookup_key"), F.col("_chunk")).agg(
        F.array_sort(
            F.flatten(F.collect_list(F.array_repeat(F.struct(*names), F.col("_times"))))
        ).alias(as_)
    )
    row_type = f"array<{right.select(F.struct(*names).alias('r')).schema['r'].dataType.simpleString()}>"
    chunked = left.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    joined = chunked.join(
        arrays, (F.col(left_key) == F.col("_lookup_key")) & (F.col("chunk") == F.col("_chunk")), "left"
    )
    return joined.select(
        *left.columns, F.coalesce(F.col(as_), F.array().cast(row_type)).alias(as_), "chunk"
    )


def lookup_unwound(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The same followed by an unwind that keeps unmatched rows: a left outer join."""
    other = right.withColumnRenamed(right_key, f"_r_{right_key}")
    return left.join(other, F.col(left_key) == F.col(f"_r_{right_key}"), "left").drop(
        f"_r_{right_key}"
    )


def not_in(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """SQL ``NOT IN``: one null on the other side and no row qualifies.

    Spark's own null-aware anti join must broadcast the other side. Here the three
    rules become a shuffled anti join and one scalar over the other side's counts.
    """
    found = other.select(F.col(other_key).alias("_other"))
    counts = found.agg(
        F.struct(F.count("*").alias("rows"), F.count("_other").alias("keys"))
    ).scalar()
    rest = df.join(
        found.filter(F.col("_other").isNotNull()), F.col(key) == F.col("_other"), "left_anti"
    )
    return rest.filter(
        (counts["rows"] == 0) | ((counts["rows"] == counts["keys"]) & F.col(key).isNotNull())
    )


def not_matched(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """``NOT EXISTS``: nulls on either side just do not match."""
    keys = other.select(F.col(other_key).alias("_other"))
    return df.join(keys, F.col(key) == F.col("_other"), "left_anti")


def translate(
    df: DataFrame, translations: DataFrame, key: str, value: str, as_: str, order: list[str]
) -> DataFrame:
    """Add the dictionary value of a key; of repeated dictionary keys the last counts."""
    entries = last_row_per_key(translations, [key], order).select(
        F.col(key).alias("_entry"), F.col(value).alias(as_)
    )
    return df.join(entries, F.col(key) == F.col("_entry"), "left").drop("_entry")


def denormalize_orders(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Orders with items, payments and reviews side by side; rows multiply by design.

    All three joins use the order id, so orders and each table are shuffled once. A column
    whose name is taken keeps its values under the name of its table and its own.
    """
    out = orders
    for prefix, table in (("items", items), ("payments", payments), ("reviews", reviews)):
        clash = {c: f"{prefix}_{c}" for c in table.columns if c in out.columns and c != "order_id"}
        out = out.join(table.withColumnsRenamed(clash), "order_id", "left")
    return out
