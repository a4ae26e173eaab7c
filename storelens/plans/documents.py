"""Builders that turn flat tables into nested documents. Joins and aggregates, no row loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.geo import geojson_point
from storelens.functions.scalars import (
    exact_mean,
    lenient_timestamp,
    or_zero,
    photo_urls,
    product_name,
    volume_or_null,
    whole_or_null,
    year_month,
)
from storelens.operators.aggregates import first_row_per_key, last_row_per_key, sorted_set
from storelens.operators.joins import translate
from storelens.operators.reshape import as_document, pairs, present_map
from storelens.operators.runs import numbered

Tables = dict[str, DataFrame]


def products_catalog(tables: Tables) -> DataFrame:
    """Products with category, metrics, attribute pairs and dimensions."""
    named = translate(
        tables["products"],
        tables["product_categories"],
        "product_category_name",
        "product_category_name_english",
        "name_en",
        ["product_category_name_english"],
    )
    length, height, width = (
        F.col(c).cast("double")
        for c in ("product_length_cm", "product_height_cm", "product_width_cm")
    )
    weight = F.col("product_weight_g").cast("double")
    sides = {
        "weight_g": weight,
        "length_cm": length,
        "height_cm": height,
        "width_cm": width,
        "volume_cm3": volume_or_null(length, height, width),
    }
    return named.select(
        "product_id",
        F.struct(
            F.coalesce("product_category_name", F.lit("unknown")).alias("name_pt"), F.col("name_en")
        ).alias("category"),
        F.struct(
            whole_or_null(F.col("product_name_lenght")).alias("name_length"),
            whole_or_null(F.col("product_description_lenght")).alias("description_length"),
            whole_or_null(F.col("product_photos_qty")).alias("photos_qty"),
        ).alias("metrics"),
        pairs(sides).alias("attributes"),
        F.struct(*[v.alias(k) for k, v in sides.items()]).alias("dimensions"),
    )


def _as_time(df: DataFrame, name: str) -> Column:
    """Times pass through; text is parsed, null where it does not parse."""
    if df.schema[name].dataType.simpleString() == "string":
        return lenient_timestamp(F.col(name))
    return F.col(name)


def load(base: DataFrame, documents: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The collection after loading documents: one per key, the last by ``order``, whole documents replaced."""
    newest = last_row_per_key(documents, [key], order)
    held = newest.select(F.col(key).alias("_loaded"))
    kept = base.join(held, F.col(key).eqNullSafe(F.col("_loaded")), "left_anti")
    return kept.unionByName(newest, allowMissingColumns=True)


def order_reviews(tables: Tables) -> DataFrame:
    reviews = tables["order_reviews"]
    return reviews.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        _as_time(reviews, "review_creation_date").alias("review_creation_date"),
        _as_time(reviews, "review_answer_timestamp").alias("review_answer_timestamp"),
    )


def payment_summaries(payments: DataFrame) -> DataFrame:
    """Per order: total, sorted distinct types, most instalments."""
    return payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("total_value"),
        sorted_set("payment_type").alias("payment_types"),
        F.max("payment_installments").alias("max_installments"),
    )


def orders_analytics(tables: Tables) -> DataFrame:
    """Orders with the customer and a payment summary embedded.

    A repeated customer id counts once: the last row by person, zip prefix, city and state.
    """
    orders = tables["orders"]
    purchase = _as_time(orders, "order_purchase_timestamp")
    base = orders.select(
        "order_id", "customer_id", F.col("order_status").alias("status"), purchase.alias("purchase_ts")
    )
    parts = ["customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]
    once = last_row_per_key(tables["customers"].select("customer_id", *parts), ["customer_id"], parts)
    customers = once.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_state").alias("state"),
        F.col("customer_city").alias("city"),
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
    )
    joined = base.join(customers, "customer_id", "left").join(
        payment_summaries(tables["order_payments"]), "order_id", "left"
    )
    return joined.select(
        "order_id",
        "status",
        "purchase_ts",
        year_month(F.col("purchase_ts")).alias("purchase_year_month"),
        F.struct("customer_id", "customer_unique_id", "state", "city", "zip_code_prefix").alias(
            "customer"
        ),
        F.struct(
            or_zero(F.col("total_value")).alias("total_value"),
            F.coalesce("payment_types", F.array().cast("array<string>")).alias("payment_types"),
            F.col("max_installments"),
        ).alias("payment_summary"),
    )


def seller_state_buckets(tables: Tables, buckets: int) -> DataFrame:
    """Sellers grouped by state, each state in ``buckets`` documents at most.

    ``bucket`` numbers a state's documents, to which sellers are dealt by a hash of their id;
    ``seller_count`` and ``state_sellers`` count the sellers of the state in every one of them. The
    number of buckets is the caller's, never the data's: choose it so that a crowded state's documents stay small.
    """
    sellers = tables["sellers"].filter(F.col("seller_state").isNotNull())
    sizes = sellers.groupBy(F.col("seller_state").alias("_state")).agg(
        F.count("*").alias("state_sellers")
    )
    documents = (
        sellers.withColumn("bucket", F.pmod(F.xxhash64("seller_id"), F.lit(buckets)).cast("int"))
        .groupBy(F.col("seller_state").alias("state"), "bucket")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "seller_id",
                        F.col("seller_city").alias("city"),
                        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
                    )
                )
            ).alias("sellers")
        )
    )
    return documents.join(sizes, F.col("state") == F.col("_state")).select(
        "state", "bucket", F.col("state_sellers").alias("seller_count"), "state_sellers", "sellers"
    )


def geolocation_points(tables: Tables) -> DataFrame:
    return tables["geo_locations"].select(
        "zip_code_prefix",
        "city",
        "state",
        geojson_point(F.col("longitude"), F.col("latitude")).alias("location"),
    )


def _order_scores(reviews: DataFrame) -> DataFrame:
    """Review scores reduced to one row per order before any join."""
    return reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"), F.count("review_score").alias("score_count")
    )


def _mean_score(items: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """Mean review score of the orders that hold a product (or seller), one decimal."""
    held = items.select("order_id", key).distinct()
    return (
        held.join(_order_scores(reviews), "order_id")
        .groupBy(key)
        .agg(
            exact_mean(F.sum("score_sum"), F.sum("score_count"), 1).cast("double").alias("mean_score")
        )
    )


def enriched_catalog(
    tables: Tables, as_of: Column | None = None, photo_host: str = "https://images.example"
) -> DataFrame:
    """Catalogue documents with price, units sold and rating worked out beforehand."""
    items = tables["order_items"]
    sales = items.groupBy("product_id").agg(
        exact_mean(F.sum("price"), F.count("price"), 2).alias("price"),
        F.count("order_item_id").alias("units"),
    )
    ratings = _mean_score(items, tables["order_reviews"], "product_id")
    joined = (
        tables["products"].join(sales, "product_id", "left").join(ratings, "product_id", "left")
    )
    category = F.coalesce("product_category_name", F.lit("general"))
    count_text = lambda name: F.col(name).cast("bigint")
    return joined.select(
        "product_id",
        product_name(category, F.col("product_id")).alias("name"),
        category.alias("category"),
        or_zero(F.col("price")).cast("double").alias("price"),
        photo_urls(F.col("product_id"), photo_host).alias("photos"),
        present_map(
            {
                "name_length": count_text("product_name_lenght"),
                "description_length": count_text("product_description_lenght"),
                "photos_qty": count_text("product_photos_qty"),
            }
        ).alias("specifications"),
        F.struct(
            or_zero(F.col("units")).alias("total_units_sold"),
            F.coalesce("mean_score", F.lit(0.0)).alias("average_rating"),
        ).alias("computed_metrics"),
        F.struct(
            F.col("product_weight_g").cast("double").alias("weight_g"),
            F.col("product_length_cm").cast("double").alias("length_cm"),
            F.col("product_height_cm").cast("double").alias("height_cm"),
            F.col("product_width_cm").cast("double").alias("width_cm"),
        ).alias("dimensions"),
        (as_of if as_of is not None else F.current_timestamp()).alias("created_at"),
    )


def customer_behavior(
    tables: Tables, as_of: Column | None = None, all_ids: bool = False
) -> DataFrame:
    """One document per person with the last purchase time.

    A person's lowest customer id is the one kept. As in the source model, only that id's
    orders count; ``all_ids`` takes the last purchase over all ids of the person.
    """
    orders = tables["orders"]
    latest = orders.select(
        "customer_id", _as_time(orders, "order_purchase_timestamp").alias("last_purchase")
    )
    latest = latest.groupBy("customer_id").agg(F.max("last_purchase").alias("last_purchase"))
    customers = tables["customers"].select("customer_id", "customer_unique_id")
    now = as_of if as_of is not None else F.current_timestamp()
    if all_ids:
        people = (
            customers.join(latest, "customer_id", "left")
            .groupBy("customer_unique_id")
            .agg(F.max("last_purchase").alias("last_purchase"))
        )
    else:
        kept = first_row_per_key(customers, ["customer_unique_id"], ["customer_id"])
        people = kept.join(latest, "customer_id", "left")
    return people.select(
        "customer_unique_id", F.coalesce("last_purchase", now).alias("last_session_date")
    )


def seller_metrics(tables: Tables, period: str = "2018-08") -> DataFrame:
    """Sales, orders, rating and mean shipping hours per seller.

    Shipping hours run from hand-over to the carrier to delivery, one value per order.
    """
    items = tables["order_items"]
    per_order = items.groupBy("seller_id", "order_id").agg(F.sum("price").alias("sales"))
    orders = tables["orders"]
    hours = (
        F.unix_seconds(F.col("order_delivered_customer_date").cast("timestamp"))
        - F.unix_seconds(F.col("order_delivered_carrier_date").cast("timestamp"))
    ) / 3600
    shipped = orders.select("order_id", hours.alias("hours"))
    joined = per_order.join(shipped, "order_id", "left").join(
        _order_scores(tables["order_reviews"]), "order_id", "left"
    )
    kpis = joined.groupBy("seller_id").agg(
        F.bround(F.sum("sales"), 2).alias("total_sales"),
        F.count("*").alias("orders"),
        F.bround(F.avg("hours"), 1).alias("avg_shipping_hours"),
        exact_mean(F.sum("score_sum"), F.sum("score_count"), 1).cast("double").alias("reputation"),
    )
    return kpis.select(
        "seller_id",
        F.col("reputation").alias("reputation_score"),
        F.struct(
            F.lit(period).alias("period"), "total_sales", "orders", "avg_shipping_hours"
        ).alias("kpis"),
    )


def review_documents(tables: Tables, as_of: Column | None = None) -> DataFrame:
    """Reviews as JSON text: absent title, message and answer are left out."""
    typed = order_reviews(tables)
    now = as_of if as_of is not None else F.current_timestamp()
    return typed.select(
        "review_id",
        as_document(
            [
                F.col("review_id").cast("string").alias("review_id"),
                F.col("order_id").cast("string").alias("order_id"),
                "review_score",
                "review_comment_title",
                "review_comment_message",
                F.coalesce("review_creation_date", now).alias("review_creation_date"),
                "review_answer_timestamp",
            ]
        ).alias("document"),
    )


def zip_dimension(geolocations: DataFrame, order: list[str]) -> DataFrame:
    """One location per zip prefix: the first by an explicit order."""
    return first_row_per_key(geolocations, ["geolocation_zip_code_prefix"], order).select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        F.trim("geolocation_city").alias("city"),
        F.trim("geolocation_state").alias("state"),
        F.col("geolocation_lat").cast("decimal(10,7)").alias("latitude"),
        F.col("geolocation_lng").cast("decimal(10,7)").alias("longitude"),
    )


def category_dimension(categories: DataFrame, name: str, english: str) -> DataFrame:
    """Distinct categories with ids 1..N in name order.

    Names are dealt to ranges, and each range begins its numbers where the ranges before it end.
    """
    names = first_row_per_key(
        categories.filter(F.col(name).isNotNull()).select(name, english), [name], [english]
    )
    return numbered(names, [name], "category_id", "categories").select(
        "category_id", F.col(name).alias("name_pt"), F.col(english).alias("name_en")
    )
