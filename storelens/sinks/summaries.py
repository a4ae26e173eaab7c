"""Saved summaries kept up to date by the rows that changed, without reading the table again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: sign of a changed row: it came (1) or went (-1); an update is one of each
SIGN = "_sign"


def changes(gone: DataFrame | None = None, came: DataFrame | None = None) -> DataFrame:
    """Rows that went and rows that came in one signed frame; an update gives its old and its new row."""
    frames = [df.withColumn(SIGN, F.lit(sign)) for df, sign in ((gone, -1), (came, 1)) if df is not None]
    return reduce(DataFrame.unionByName, frames)


def build(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Per group: ``n`` rows and, of each measure, how many are known, sum, least and largest.

    Sums of decimals and whole numbers are exact, so they can be taken back; floating ones are refused.
    """
    _exact(df, measures)
    aggregates = [F.count("*").alias("n")]
    for m in measures:
        aggregates += [F.count(m).alias(f"{m}_known"), F.sum(m).alias(f"{m}_sum"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
    return df.groupBy(*keys).agg(*aggregates)


def refresh(state: DataFrame, changed: DataFrame, keys: list[str], measures: list[str], table: DataFrame) -> DataFrame:
    """The summary after the changes, equal to ``build(table)``.

    Counts and sums take the signed totals of the changed rows. Least and largest do so as long as what went
    is within what stays; groups whose least or largest went are looked up in ``table``, which is read for those
    groups alone (prune it by partition if the keys allow). Groups without rows go. Null keys are a group.
    """
    _exact(changed, measures)
    came, went = F.col(SIGN) > 0, F.col(SIGN) < 0
    totals = [F.sum(SIGN).cast("bigint").alias("d_n")]
    for m in measures:
        totals += [
            F.sum(F.when(F.col(m).isNotNull(), F.col(SIGN))).cast("bigint").alias(f"d_{m}_known"),
            F.sum(F.col(m) * F.col(SIGN)).alias(f"d_{m}_sum"),
            *(F.min(F.when(when, F.col(m))).alias(f"d_{m}_min_{x}") for when, x in ((came, "in"), (went, "out"))),
            *(F.max(F.when(when, F.col(m))).alias(f"d_{m}_max_{x}") for when, x in ((came, "in"), (went, "out"))),
        ]
    delta = changed.groupBy(*(F.col(k).alias(f"d_{k}") for k in keys)).agg(*totals)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"d_{k}")) for k in keys])
    both = state.withColumn("_old", F.lit(True)).join(delta.withColumn("_new", F.lit(True)), on, "full_outer")
    zero = F.lit(0)
    out = [F.when(F.col("_old").isNull(), F.col(f"d_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    out.append((F.coalesce("n", zero) + F.coalesce("d_n", zero)).alias("n"))
    stale = F.lit(False)
    for m in measures:
        known = F.coalesce(f"{m}_known", zero) + F.coalesce(f"d_{m}_known", zero)
        kind = state.schema[f"{m}_sum"].dataType
        total = F.coalesce(f"{m}_sum", F.lit(0).cast(kind)) + F.coalesce(f"d_{m}_sum", F.lit(0).cast(kind))
        out += [known.alias(f"{m}_known"), F.when(known > 0, total.cast(kind)).alias(f"{m}_sum")]
        for end, pick in (("min", F.least), ("max", F.greatest)):
            now, gone = pick(F.col(f"{m}_{end}"), F.col(f"d_{m}_{end}_in")), F.col(f"d_{m}_{end}_out")
            out.append(now.alias(f"{m}_{end}"))
            beyond = gone <= now if end == "min" else gone >= now
            stale = stale | F.coalesce(beyond, F.lit(False))
    merged = both.select(*out, stale.alias("_stale"), F.col("_new").alias("_new")).filter("n > 0")
    settled = merged.filter(~F.col("_stale")).drop("_stale", "_new")
    again = merged.filter("_stale").select(*(F.col(k).alias(f"d_{k}") for k in keys))
    return settled.unionByName(build(table.join(again, on, "left_semi"), keys, measures).select(*settled.columns))


def _exact(df: DataFrame, measures: list[str]) -> None:
    inexact = [m for m in measures if df.schema[m].dataType.simpleString() in ("float", "double")]
    if inexact:
        raise ValueError(f"sums of floating numbers cannot be taken back: {inexact}; cast them to decimal")
