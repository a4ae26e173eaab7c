"""Upsert and insert-ignore as whole-table transformations.

Parquet has no row update: write the result to a new path, then point readers at it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.operators.aggregates import first_row_per_key, last_row_per_key


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys: list[str],
    order: list[str],
    keep_when_null: bool = False,
    stamp: tuple[str, Column] | None = None,
) -> DataFrame:
    """Set the updates' columns on matching rows and add the other updates as new rows.

    Of several updates to a key the last by ``order`` wins; null keys are equal. Columns that only the base
    has keep their value; with ``keep_when_null`` a null in an update does so too.
    ``stamp`` names a time column set on rows that are new or really change.
    """
    newest = last_row_per_key(updates, keys, order)
    stamp_name = stamp[0] if stamp else None
    set_columns = [c for c in newest.columns if c not in keys and c != stamp_name]
    b = base.withColumn("_base", F.lit(True)).alias("b")
    u = newest.withColumn("_hit", F.lit(True)).alias("u")
    on = reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys])
    joined = b.join(u, on, "full_outer")
    hit = F.col("u._hit").isNotNull()
    out: dict[str, Column] = {}
    for name in [*base.columns, *[c for c in newest.columns if c not in base.columns]]:
        if name == stamp_name:
            continue
        in_base, in_updates = name in base.columns, name in newest.columns
        if name in keys:
            value = F.coalesce(F.col(f"u.{name}"), F.col(f"b.{name}"))
        elif in_base and in_updates:
            new = F.col(f"u.{name}")
            if keep_when_null:
                new = F.coalesce(new, F.col(f"b.{name}"))
            value = F.when(hit, new).otherwise(F.col(f"b.{name}"))
        elif in_updates:
            value = F.col(f"u.{name}")
        else:
            value = F.col(f"b.{name}")
        out[name] = value
    columns = [value.alias(name) for name, value in out.items()]
    if stamp:
        base_keys_missing = F.col("b._base").isNull()
        differs = F.lit(False)
        for name in set_columns:
            old = F.col(f"b.{name}") if name in base.columns else F.lit(None)
            differs = differs | ~out[name].eqNullSafe(old)
        old_stamp = F.col(f"b.{stamp_name}") if stamp_name in base.columns else F.lit(None)
        columns.append(
            F.when(hit & (base_keys_missing | differs), stamp[1])
            .otherwise(old_stamp)
            .alias(stamp_name)
        )
    return joined.select(*columns)


def insert_ignore(
    base: DataFrame, new: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Base plus the new rows whose key it lacks; the first by ``order`` of each key counts."""
    held = base.select(*(F.col(k).alias(f"_held_{k}") for k in keys))
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
    missing = first_row_per_key(new, keys, order).join(held, on, "left_anti")
    return base.unionByName(missing.select(*base.columns))
