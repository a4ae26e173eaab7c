"""Sorting, top-n and paging. Sorts name their null order and end in a unique key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def oldest_first(name: str) -> Column:
    """Ascending, nulls last."""
    return F.col(name).asc_nulls_last()


def newest_first(name: str) -> Column:
    """Descending, nulls first."""
    return F.col(name).desc_nulls_first()


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Each task keeps its best n; only those leave it."""
    return df.orderBy(*order).limit(n)


def offset_page(df: DataFrame, key: str, skip: int, n: int) -> DataFrame:
    """Page by position. Work grows with the position; prefer ``keyset_page``."""
    return df.orderBy(oldest_first(key)).offset(skip).limit(n)


def keyset_page(df: DataFrame, key: str, cursor, n: int) -> DataFrame:
    """The n rows after the last key seen. The filter reaches the scan."""
    rows = df if cursor is None else df.filter(F.col(key) > F.lit(cursor))
    return rows.orderBy(F.col(key).asc()).limit(n)
