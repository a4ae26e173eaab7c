"""Reports over nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.predicates import has_text, time_range
from storelens.functions.scalars import exact_mean, month_start, revenue
from storelens.operators.aggregates import bucket_groups, facet
from storelens.operators.paging import newest_first, oldest_first, top_n


def revenue_groups(
    orders: DataFrame,
    reviews: DataFrame,
    status: str = "delivered",
    lo: str = "2017-01-01",
    hi: str = "2018-01-01",
) -> DataFrame:
    """Orders, revenue and mean score per state and month.

    An order counts once per review it has (once if it has none), and so does its
    revenue. Reviews are reduced to one row per order before the join and the counts are
    multiplied, so that repetition is never materialised.
    """
    per_order = reviews.groupBy(F.col("order_id").alias("reviewed_id")).agg(
        F.count("*").alias("reviews"),
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("scores"),
    )
    kept = orders.filter((F.col("status") == status) & time_range(F.col("purchase_ts"), lo, hi))
    rows = kept.select(
        "order_id",
        F.col("customer.state").alias("state"),
        month_start(orders, "purchase_ts").alias("month"),
        F.coalesce(F.col("payment_summary.total_value"), F.lit(0)).alias("value"),
    ).join(per_order, F.col("order_id") == F.col("reviewed_id"), "left")
    times = F.coalesce("reviews", F.lit(1))
    return rows.groupBy("state", "month").agg(
        F.sum(times).alias("total_orders"),
        F.bround(F.sum(F.col("value") * times.cast("decimal(12,0)")), 2).alias("total_revenue"),
        exact_mean(F.sum("score_sum"), F.sum("scores"), 2)
        .cast("double")
        .alias("avg_review_score"),
    )


def revenue_by_state_month(
    orders: DataFrame,
    reviews: DataFrame,
    status: str = "delivered",
    lo: str = "2017-01-01",
    hi: str = "2018-01-01",
    top: int = 10,
    path: str | None = None,
) -> DataFrame:
    """Two facets: the ``top`` state-months by revenue, and the grand summary.

    The summary's score is the plain mean of the groups' rounded means. ``path`` names a
    shared folder for the groups, so that both facets read them ready-made.
    """
    groups = revenue_groups(orders, reviews, status, lo, hi)
    return facet(
        groups,
        {
            "top_states": lambda g: top_n(
                g, top, newest_first("total_revenue"), oldest_first("state"), oldest_first("month")
            ),
            "summary": lambda g: g.agg(
                F.sum("total_orders").alias("total_orders"),
                F.sum("total_revenue").alias("total_revenue"),
                (
                    F.sum(F.col("avg_review_score").cast("decimal(10,2)")).cast("double")
                    / F.count("avg_review_score")
                ).alias("avg_review_score"),
            ),
        },
        path,
    )


def revenue_plain(
    orders: DataFrame,
    reviews: DataFrame,
    status: str = "delivered",
    lo: str = "2017-01-01",
    hi: str = "2018-01-01",
) -> DataFrame:
    """The short form: no score, no facets, revenue not rounded."""
    per_order = reviews.groupBy(F.col("order_id").alias("reviewed_id")).agg(
        F.count("*").alias("reviews")
    )
    kept = orders.filter((F.col("status") == status) & time_range(F.col("purchase_ts"), lo, hi))
    rows = kept.select(
        "order_id",
        F.col("customer.state").alias("state"),
        month_start(orders, "purchase_ts").alias("month"),
        F.col("payment_summary.total_value").alias("value"),
    ).join(per_order, F.col("order_id") == F.col("reviewed_id"), "left")
    times = F.coalesce("reviews", F.lit(1))
    return (
        rows.groupBy("state", "month")
        .agg(
            F.sum(times).alias("total_orders"),
            F.coalesce(
                F.sum(F.col("value") * times.cast("decimal(12,0)")), F.lit(0)
            ).alias("total_revenue"),
        )
        .orderBy(newest_first("total_revenue"), oldest_first("state"), oldest_first("month"))
    )


def low_score_reviews(
    reviews: DataFrame, max_score: int = 3, bounds: tuple[int, ...] = (1, 2, 3, 4)
) -> DataFrame:
    """Low-score reviews with a comment: number and mean comment length per score."""
    rows = reviews.filter(
        (F.col("review_score") <= max_score) & has_text(F.col("review_comment_message"))
    ).withColumn("comment_length", F.char_length("review_comment_message"))
    return bucket_groups(
        rows,
        "review_score",
        list(bounds),
        [
            F.count("*").alias("total_reviews"),
            F.avg("comment_length").alias("avg_comment_length"),
        ],
    )


def category_attributes(
    catalog: DataFrame,
    names: tuple[str, ...] = ("weight_g", "volume_cm3", "photos_qty"),
    n: int = 15,
) -> DataFrame:
    """Categories by number of matching attributes, with mean weight and volume.

    A product counts once per attribute with one of the names. The matches are counted
    inside the array and used as weights, so the pairs are not unwound into rows.
    """
    matched = catalog.filter(F.col("category.name_en").isNotNull()).select(
        F.col("category.name_en").alias("category"),
        F.size(F.filter("attributes", lambda a: a["k"].isin(list(names)))).alias("m"),
        F.col("dimensions.weight_g").alias("weight"),
        F.col("dimensions.volume_cm3").alias("volume"),
    )

    def weighted(value: str) -> Column:
        count = F.sum(F.when(F.col(value).isNotNull(), F.col("m")))
        total = F.sum(F.col(value).cast("decimal(20,6)") * F.col("m"))
        return exact_mean(total, count, 2).cast("double")

    groups = (
        matched.filter(F.col("m") > 0)
        .groupBy("category")
        .agg(
            F.sum("m").alias("product_count"),
            weighted("weight").alias("avg_weight"),
            weighted("volume").alias("avg_volume"),
        )
    )
    return top_n(groups, n, newest_first("product_count"), oldest_first("category"))


def category_attributes_by_product(
    catalog: DataFrame,
    names: tuple[str, ...] = ("weight_g", "volume_cm3", "photos_qty"),
    n: int = 15,
) -> DataFrame:
    """Corrected variant: each product with any of the attributes counts once."""
    once = catalog.filter(F.exists("attributes", lambda a: a["k"].isin(list(names)))).withColumn(
        "attributes", F.slice(F.filter("attributes", lambda a: a["k"].isin(list(names))), 1, 1)
    )
    return category_attributes(once, names, n)


def income_by_rating(catalog: DataFrame, categories: tuple[str, ...] = ("perfumery",)) -> DataFrame:
    """Photos and mean income per rating within some categories.

    A product counts once per photo (once if it has none), again as a weight.
    """
    rows = catalog.filter(F.col("category").isin(list(categories))).select(
        F.coalesce(F.col("computed_metrics.average_rating"), F.lit(0.0)).alias("rating"),
        F.greatest(F.coalesce(F.size("photos"), F.lit(0)), F.lit(1)).alias("times"),
        revenue(F.col("price"), F.col("computed_metrics.total_units_sold"))
        .cast("decimal(20,2)")
        .alias("income"),
    )
    return (
        rows.groupBy("rating")
        .agg(
            F.sum("times").alias("total_photos"),
            (
                F.sum(F.col("income") * F.col("times").cast("decimal(10,0)")).cast("double")
                / F.sum("times")
            ).alias("avg_income"),
        )
        .orderBy(newest_first("avg_income"), oldest_first("rating"))
    )


def best_sellers(
    catalog: DataFrame, categories: tuple[str, ...] = ("perfumery",), max_price: float = 50
) -> DataFrame:
    """Products of some categories under a price, most sold first."""
    return catalog.filter(
        F.col("category").isin(list(categories)) & (F.col("price") < max_price)
    ).orderBy(newest_first("computed_metrics.total_units_sold"), oldest_first("product_id"))
