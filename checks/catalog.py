"""The list of registered queries and their oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import CommerceTables, oracle
from storelens.session import bytes_under, configure, fit_tasks

QUERIES: dict[str, Callable[[CommerceTables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def case(name: str, sql: str | None = None):
    """Register a query under its inventory id, with the SQL it must agree with."""

    def add(fn: Callable[[CommerceTables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return add


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fit_tasks(configure(spark), bytes_under(spark, sf_dir))
        return QUERIES[name](CommerceTables(spark, sf_dir))

    return run


def dbl(name: str, places: int = 6) -> Column:
    """A number as a rounded double, so that both engines print it alike."""
    return F.round(F.col(name).cast("double"), places).alias(name)
