"""Before/after comparison of two timing runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.scalars import improvement_percent


def compare_runs(
    before: DataFrame, after: DataFrame, key: str = "query", value: str = "execution_time_ms"
) -> DataFrame:
    """Both runs side by side with the percent saved; a query of one run only is kept."""
    b = before.select(key, F.col(value).alias(f"{value}_before"))
    a = after.select(key, F.col(value).alias(f"{value}_after"))
    return b.join(a, key, "full_outer").withColumn(
        "improvement_percent",
        improvement_percent(F.col(f"{value}_before"), F.col(f"{value}_after")),
    )
