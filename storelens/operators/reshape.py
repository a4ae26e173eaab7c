"""Nested records: unwinding, building, flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unwind(df: DataFrame, column: str, as_: str, keep_empty: bool = False) -> DataFrame:
    """One row per array element; null and empty arrays vanish or give one null row."""
    explode = F.explode_outer if keep_empty else F.explode
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, explode(F.col(column)).alias(as_))


def pairs(values: dict[str, Column]) -> Column:
    """``[{k, v}]`` with a numeric value; a missing value stays as a null ``v``."""
    return F.array(
        *[F.struct(F.lit(k).alias("k"), v.cast("double").alias("v")) for k, v in values.items()]
    )


def pair_value(column: str, key: str) -> Column:
    """The value of the first pair with that key, else null."""
    return F.get(F.filter(F.col(column), lambda p: p["k"] == key), F.lit(0))["v"]


def present_map(values: dict[str, Column]) -> Column:
    """A string map that holds only the keys with a value."""
    entries = [x for k, v in values.items() for x in (F.lit(k), v.cast("string"))]
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def as_document(columns: list, keep_nulls: bool = False) -> Column:
    """JSON text of the columns; null fields are left out unless asked for."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return F.to_json(F.struct(*columns), options)
