"""Reporting queries. ``tables`` maps table names to DataFrames; literals are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.geo import geodesic_pairs_m, nearest
from storelens.functions.predicates import (
    active_at,
    array_has_all,
    folded_contains,
    is_late,
    json_contains,
    time_range,
)
from storelens.functions.scalars import month_start
from storelens.functions.text import fuzzy_search
from storelens.operators.paging import newest_first, oldest_first

Tables = dict[str, DataFrame]


def orders_by_state_month(
    tables: Tables, status: str = "delivered", lo: str = "2017-01-01", hi: str = "2018-01-01"
) -> DataFrame:
    """Orders of one status per customer state and month."""
    orders = tables["orders"]
    kept = orders.filter(
        (F.col("order_status") == status) & time_range(F.col("order_purchase_timestamp"), lo, hi)
    ).select(
        "customer_id", month_start(orders, "order_purchase_timestamp").alias("purchase_month")
    )
    customers = tables["customers"].select("customer_id", "customer_state")
    return (
        kept.join(customers, "customer_id")
        .groupBy("customer_state", "purchase_month")
        .agg(F.count("*").alias("total_orders"))
        .orderBy(
            oldest_first("purchase_month"),
            newest_first("total_orders"),
            oldest_first("customer_state"),
        )
    )


def payments_by_type(tables: Tables, min_value=0) -> DataFrame:
    """Count, total and mean of payments above ``min_value`` per type."""
    return (
        tables["order_payments"]
        .filter(F.col("payment_value") > min_value)
        .groupBy("payment_type")
        .agg(
            F.count("*").alias("total_payments"),
            F.sum("payment_value").alias("total_value"),
            F.avg("payment_value").alias("avg_value"),
        )
        .orderBy(newest_first("total_value"), oldest_first("payment_type"))
    )


def late_deliveries(tables: Tables) -> DataFrame:
    """Orders delivered after their estimate, per customer state.

    Late orders are counted per customer first: the join then uses that same partitioning,
    and a customer with very many orders arrives as one row per task.
    """
    late = (
        tables["orders"]
        .filter(is_late(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")))
        .groupBy("customer_id")
        .agg(F.count("*").alias("late"))
    )
    return (
        late.join(tables["customers"].select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(F.sum("late").alias("late_orders"))
        .orderBy(newest_first("late_orders"), oldest_first("customer_state"))
    )


def folded_text_counts(df: DataFrame, text: str, needle: str, keys: list[str], count: str) -> DataFrame:
    """Rows whose text holds the needle in any case and accents, counted by keys."""
    return (
        df.filter(folded_contains(F.col(text), needle))
        .groupBy(*keys)
        .agg(F.count("*").alias(count))
        .orderBy(newest_first(count), *[oldest_first(k) for k in keys])
    )


def city_search(tables: Tables, needle: str = "sao paulo") -> DataFrame:
    return folded_text_counts(
        tables["geolocations"],
        "geolocation_city",
        needle,
        ["geolocation_city", "geolocation_state"],
        "points",
    )


def nearest_points(
    tables: Tables, lng: float = -46.6333, lat: float = -23.5505, n: int = 20
) -> DataFrame:
    """The n recorded points nearest to a place, with metres."""
    found = nearest(
        tables["geolocations"],
        "geolocation_lat",
        "geolocation_lng",
        lat,
        lng,
        n,
        ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"],
    )
    return found.select(
        "geolocation_zip_code_prefix", "geolocation_city", "geolocation_state", "distance_meters"
    ).orderBy("distance_meters", "geolocation_zip_code_prefix")


def products_with_spec(tables: Tables, wanted: dict | None = None) -> DataFrame:
    """Products whose JSON specification holds ``wanted``."""
    wanted = wanted if wanted is not None else {"logistics": {"weight_class": "heavy"}}
    return (
        tables["products"]
        .filter(json_contains(F.col("product_specifications"), wanted))
        .select("product_id", "product_specifications")
    )


def orders_with_metadata(tables: Tables, wanted: dict | None = None) -> DataFrame:
    wanted = wanted if wanted is not None else {"gift": True, "channel": "app_ios"}
    return tables["orders"].filter(json_contains(F.col("metadata"), wanted)).select("order_id")


def products_with_token(tables: Tables, tokens: list[str] | None = None) -> DataFrame:
    tokens = tokens if tokens is not None else ["technology"]
    return (
        tables["products"]
        .filter(array_has_all(F.col("search_tokens"), tokens))
        .select("product_id", "search_tokens")
    )


def active_promotions(
    tables: Tables, as_of: str | Column | None = None, product_id=None
) -> DataFrame:
    """Promotions whose period holds the instant (now if none is given)."""
    promotions = tables["product_promotions"]
    if product_id is not None:
        promotions = promotions.filter(F.col("product_id") == F.lit(product_id))
    at = as_of if as_of is not None else F.current_timestamp()
    return promotions.filter(active_at(F.col("period_lo"), F.col("period_hi"), at)).select(
        "promotion_id", "product_id", "discount_percentage"
    )


def category_fuzzy(
    tables: Tables, text: str = "computer accesories", threshold: float = 0.3
) -> DataFrame:
    """Categories with a name similar to a misspelt text, best first."""
    return (
        fuzzy_search(tables["categories"], "name_en", text, threshold)
        .select("category_id", "name_en", "score")
        .orderBy(newest_first("score"), oldest_first("category_id"))
    )


def zip_distance(tables: Tables, seller_zip: int = 1001, customer_zip: int = 13050) -> DataFrame:
    """Kilometres between two zip prefixes.

    The pair is a one-row table joined on equality to each end's (filtered) locations.
    """
    geo = tables["geo_locations"]
    pair = geo.sparkSession.createDataFrame(
        [(seller_zip, customer_zip)], "seller_zip int, customer_zip int"
    )
    return pair_distances(
        pair, geo.filter(F.col("zip_code_prefix").isin(seller_zip, customer_zip))
    )


def pair_distances(pairs: DataFrame, geo: DataFrame) -> DataFrame:
    """Kilometres for each (seller_zip, customer_zip) pair with known ends."""

    def ends(side: str) -> DataFrame:
        return geo.select(
            F.col("zip_code_prefix").cast("int").alias(f"{side}_zip"),
            F.col("latitude").cast("double").alias(f"{side}_lat"),
            F.col("longitude").cast("double").alias(f"{side}_lng"),
        )

    located = pairs.join(ends("seller"), "seller_zip").join(ends("customer"), "customer_zip")
    metres = geodesic_pairs_m(
        F.col("seller_lat"), F.col("seller_lng"), F.col("customer_lat"), F.col("customer_lng")
    )
    return located.select("seller_zip", "customer_zip", (metres / 1000).alias("distance_km"))


def monthly_summary(tables: Tables) -> DataFrame:
    """Orders per customer state, month and status: the saved dashboard summary."""
    orders = tables["orders"]
    slim = orders.select(
        "customer_id",
        month_start(orders, "order_purchase_timestamp").alias("purchase_month"),
        "order_status",
    )
    return (
        slim.join(tables["customers"].select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state", "purchase_month", "order_status")
        .agg(F.count("*").alias("total_orders"))
    )
