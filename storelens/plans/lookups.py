"""Critical lookups and the two forms of each rewritten query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.predicates import day_range, month_range, truncated_day_is
from storelens.operators.joins import not_in, not_matched
from storelens.operators.paging import keyset_page, newest_first, offset_page, oldest_first, top_n

Tables = dict[str, DataFrame]


def order_detail(tables: Tables, order_id) -> DataFrame:
    return tables["orders"].filter(F.col("order_id") == F.lit(order_id))


def order_tracking(tables: Tables, order_id) -> DataFrame:
    return order_detail(tables, order_id).select(
        "order_status", "order_delivered_customer_date", "order_estimated_delivery_date"
    )


def order_status(orders: DataFrame, order_id) -> DataFrame:
    """Status by id. On a table split by time this reads every split: the id names none."""
    return orders.filter(F.col("order_id") == F.lit(order_id)).select("order_status")


def customer_history(tables: Tables, customer_unique_id, n: int = 20) -> DataFrame:
    """One person's newest orders, over all their customer ids."""
    person = (
        tables["customers"]
        .filter(F.col("customer_unique_id") == F.lit(customer_unique_id))
        .select("customer_id")
    )
    found = tables["orders"].join(person, "customer_id").select(
        "order_id", "order_status", "order_purchase_timestamp"
    )
    return top_n(found, n, newest_first("order_purchase_timestamp"), oldest_first("order_id"))


def seller_items(
    tables: Tables,
    seller_id,
    n: int = 50,
    keys: tuple[str, ...] = ("order_id", "order_purchase_timestamp"),
) -> DataFrame:
    """One seller's latest items with their order's status."""
    items = (
        tables["order_items"]
        .filter(F.col("seller_id") == F.lit(seller_id))
        .select(*keys, "order_item_id", "product_id", "price")
    )
    orders = tables["orders"].select(*dict.fromkeys([*keys, "order_status", "order_purchase_timestamp"]))
    found = items.join(orders, list(keys))
    return top_n(
        found,
        n,
        newest_first("order_purchase_timestamp"),
        oldest_first("order_id"),
        oldest_first("order_item_id"),
        oldest_first("product_id"),
        oldest_first("price"),
    ).select("order_id", "product_id", "price", "order_status", "order_purchase_timestamp")


def catalog_page(tables: Tables, category_id, n: int = 24) -> DataFrame:
    """First page of a category by product id."""
    rows = (
        tables["products"]
        .filter(F.col("category_id") == F.lit(category_id))
        .select("product_id", "product_category_name", "product_weight_g")
    )
    return top_n(rows, n, oldest_first("product_id"))


def awaiting_approval(tables: Tables, status: str = "created", n: int = 100) -> DataFrame:
    """Oldest orders still in the given status."""
    rows = (
        tables["orders"]
        .filter(F.col("order_status") == status)
        .select("order_id", "order_purchase_timestamp")
    )
    return top_n(rows, n, oldest_first("order_purchase_timestamp"), oldest_first("order_id"))


def pending_events(tables: Tables, n: int = 100) -> DataFrame:
    """Oldest outbox events not yet processed."""
    rows = tables["outbox_events"].filter(F.col("processed_at").isNull())
    return top_n(rows, n, oldest_first("created_at"), oldest_first("event_id")).select(
        "event_id", "payload"
    )


# -- rewrites: the plain form and the one to use --------------------------------------


def _first_sellers(tables: Tables, n: int) -> DataFrame:
    return top_n(tables["sellers"].select("seller_id"), n, oldest_first("seller_id"))


def seller_sales(tables: Tables, n: int = 100) -> DataFrame:
    """Items and revenue of the first n sellers: one join, items scanned once."""
    sellers = _first_sellers(tables, n)
    items = tables["order_items"].select(F.col("seller_id").alias("item_seller"), "price")
    return (
        sellers.join(items, F.col("seller_id") == F.col("item_seller"), "left")
        .groupBy("seller_id")
        .agg(
            F.count("item_seller").alias("items_sold"),
            F.coalesce(F.sum("price"), F.lit(0).cast("decimal(22,2)")).alias("revenue"),
        )
    )


def seller_sales_correlated(tables: Tables, n: int = 100) -> DataFrame:
    """The same with one correlated subquery per value: items are scanned twice."""
    sellers = _first_sellers(tables, n).alias("s")
    own = tables["order_items"].filter(F.col("seller_id") == F.col("s.seller_id").outer())
    return sellers.select(
        F.col("s.seller_id").alias("seller_id"),
        own.select(F.count("*")).scalar().alias("items_sold"),
        own.select(F.coalesce(F.sum("price"), F.lit(0).cast("decimal(22,2)"))).scalar().alias("revenue"),
    )


def status_of_day(tables: Tables, day: str = "2018-05-10") -> DataFrame:
    """One day's orders by status; the range is pushed to the scan."""
    rows = tables["orders"].filter(day_range(F.col("order_purchase_timestamp"), day))
    return rows.groupBy("order_status").agg(F.count("*").alias("orders"))


def status_of_day_truncated(tables: Tables, day: str = "2018-05-10") -> DataFrame:
    rows = tables["orders"].filter(truncated_day_is(F.col("order_purchase_timestamp"), day))
    return rows.groupBy("order_status").agg(F.count("*").alias("orders"))


def _orders_of_day(tables: Tables, status: str, day: str) -> DataFrame:
    return (
        tables["orders"]
        .filter(
            (F.col("order_status") == status) & day_range(F.col("order_purchase_timestamp"), day)
        )
        .select("order_id")
    )


def delivered_without_review(
    tables: Tables, day: str = "2018-05-10", status: str = "delivered"
) -> DataFrame:
    """Orders of a day and status that nobody reviewed."""
    rows = not_matched(
        _orders_of_day(tables, status, day), tables["order_reviews"], "order_id", "order_id"
    )
    return rows.agg(F.count("*").alias("orders"))


def delivered_without_review_not_in(
    tables: Tables, day: str = "2018-05-10", status: str = "delivered"
) -> DataFrame:
    """The ``NOT IN`` form: a single review without an order id makes the count 0."""
    rows = not_in(
        _orders_of_day(tables, status, day), tables["order_reviews"], "order_id", "order_id"
    )
    return rows.agg(F.count("*").alias("orders"))


def deep_page_offset(tables: Tables, skip: int = 5000, n: int = 24) -> DataFrame:
    return offset_page(
        tables["products"].select("product_id", "product_category_name"), "product_id", skip, n
    )


def deep_page_keyset(tables: Tables, cursor, n: int = 24) -> DataFrame:
    return keyset_page(
        tables["products"].select("product_id", "product_category_name"), "product_id", cursor, n
    )


def month_count(orders: DataFrame, month: str = "2017-06") -> DataFrame:
    """Orders of one month, from a flat, sorted or partitioned table alike."""
    rows = orders.filter(month_range(F.col("order_purchase_timestamp"), month))
    return rows.agg(F.count("*").alias("orders"))
