"""Connected components of a graph of links, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import stored


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (``a``, ``b``): the smallest node that it reaches.

    Each round a node takes the smallest label among its neighbours', and then its label's own
    label, so chains shorten by half or more; rounds end when no label changes. Neighbours are only
    ever aggregated, so a node with many links is pre-aggregated before the shuffle.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{label}-links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root")), f"{label}-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        better = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("root").alias("far"))
        after = stored(better.join(jump, "now", "left").select("node", "root", F.least("now", "far").alias("next")), f"{label}-{step}")
        changed = after.where(F.col("next") < F.col("root")).limit(1).count()
        labels = after.select("node", F.col("next").alias("root"))
        if not changed:
            return labels
