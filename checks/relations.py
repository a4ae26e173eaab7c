"""Joins, aggregates, sorting, paging and unions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.bindings import half_even
from checks.catalog import case, dbl
from checks.reporting import _SPHERE
from storelens.functions.geo import nearest
from storelens.operators import aggregates, joins, paging
from storelens.plans import comparison, lookups

# -- joins -----------------------------------------------------------------------------


@case(
    "j01_inner_join",
    "SELECT o.order_id, c.customer_state FROM c_orders o JOIN c_customers c USING (customer_id)",
)
def _(t):
    return (
        t["orders"].join(t["customers"], "customer_id").select("order_id", "customer_state")
    )


@case(
    "j02_two_key_join",
    """SELECT i.order_id, i.order_item_id, i.seller_id, o.order_status FROM c_order_items i JOIN c_orders o
    USING (order_id)""",
)
def _(t):
    keys = ["order_id", "order_purchase_timestamp"]
    return (
        t["order_items_dated"]
        .join(t["orders"].select(*keys, "order_status"), keys)
        .select("order_id", "order_item_id", "seller_id", "order_status")
    )


@case(
    "j03_left_join",
    "SELECT o.order_id, r.review_id FROM c_orders o LEFT JOIN c_order_reviews r USING (order_id)",
)
def _(t):
    return joins.lookup_unwound(
        t["orders"].select("order_id"),
        t["order_reviews"].select("order_id", "review_id"),
        "order_id",
        "order_id",
    )


@case(
    "j04_denormalized_orders",
    """SELECT o.order_id, o.order_status, i.order_item_id, i.product_id, CAST(i.price AS DOUBLE) AS price,
    p.payment_sequential, p.payment_type, r.review_id, r.review_score FROM c_orders o
    LEFT JOIN c_order_items i USING (order_id) LEFT JOIN c_order_payments p USING (order_id)
    LEFT JOIN c_order_reviews r USING (order_id)""",
)
def _(t):
    full = joins.denormalize_orders(
        t["orders"], t["order_items"], t["order_payments"], t["order_reviews"]
    )
    return full.select(
        "order_id",
        "order_status",
        "order_item_id",
        "product_id",
        F.col("price").cast("double").alias("price"),
        "payment_sequential",
        "payment_type",
        "review_id",
        "review_score",
    )


@case(
    "j05_lookup_arrays",
    """SELECT o.order_id, count(r.review_id) AS reviews, coalesce(string_agg(CAST(r.review_id AS VARCHAR), ',' ORDER BY r.review_id), '') AS ids
    FROM c_orders o LEFT JOIN c_order_reviews r USING (order_id) GROUP BY 1""",
)
def _(t):
    found = joins.lookup(
        t["orders"].select("order_id"),
        t["order_reviews"].select("review_id", F.col("order_id").alias("reviewed")),
        "order_id",
        "reviewed",
        "reviews",
        buckets=4,
    )
    # an order's four arrays, put together again
    whole = found.groupBy("order_id").agg(F.array_sort(F.flatten(F.collect_list(F.transform("reviews", lambda r: r["review_id"])))).alias("ids"))
    return whole.select("order_id", F.size("ids").cast("bigint").alias("reviews"), F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))


@case(
    "j05_lookup_chunks",
    """SELECT p.p_partkey, count(l_orderkey) AS items, round(coalesce(sum(CAST(l_extendedprice AS DECIMAL(12,2))), 0), 2)::DOUBLE AS value,
    CAST(4 AS BIGINT) AS chunks
    FROM part p LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1""",
)
def _(t):
    """Arrays in four chunks, put together again."""
    items = t.star("lineitem").select(
        "l_partkey", "l_orderkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("price")
    )
    found = joins.lookup(
        t.star("part").select("p_partkey"), items, "p_partkey", "l_partkey", "items", buckets=4
    )
    return found.groupBy("p_partkey").agg(
        F.sum(F.size("items")).alias("items"),
        F.sum(
            F.aggregate(
                "items", F.lit(0).cast("decimal(22,2)"), lambda a, i: (a + i["price"]).cast("decimal(22,2)")
            )
        )
        .cast("double")
        .alias("value"),
        F.count("*").alias("chunks"),
    )


@case(
    "j06_lookup_unwound",
    """SELECT c.customer_id, o.order_id FROM c_customers c LEFT JOIN c_orders o USING (customer_id)""",
)
def _(t):
    return joins.lookup_unwound(
        t["customers"].select("customer_id"),
        t["orders"].select("customer_id", "order_id"),
        "customer_id",
        "customer_id",
    )


@case(
    "j07_not_exists",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def _(t):
    return joins.not_matched(
        t.star("orders").select("o_orderkey"), t.star("lineitem"), "o_orderkey", "l_orderkey"
    )


@case(
    "j08_not_in",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def _(t):
    return joins.not_in(
        t.star("orders").select("o_orderkey"), t.star("lineitem"), "o_orderkey", "l_orderkey"
    )


@case(
    "j08_not_in_with_null",
    """SELECT c.product_id FROM c_products c WHERE c.product_category_name NOT IN
    (SELECT review_comment_title FROM c_order_reviews)""",
)
def _(t):
    return joins.not_in(
        t["products"].select("product_id", "product_category_name"),
        t["order_reviews"],
        "product_category_name",
        "review_comment_title",
    ).select("product_id")


@case(
    "j10_translate",
    """SELECT product_id, product_category_name_english AS name_en FROM c_products
    LEFT JOIN c_product_categories USING (product_category_name)""",
)
def _(t):
    return joins.translate(
        t["products"],
        t["product_categories"],
        "product_category_name",
        "product_category_name_english",
        "name_en",
        ["product_category_name_english"],
    ).select("product_id", "name_en")


_J11 = """SELECT s.seller_id, count(i.seller_id) AS items_sold, CAST(coalesce(sum(i.price), 0) AS DOUBLE) AS revenue
    FROM c_sellers s LEFT JOIN c_order_items i USING (seller_id) GROUP BY 1"""


@case("j11_scalar_subqueries_as_join", _J11)
def _(t):
    sellers = t["sellers"]
    per_seller = (
        t["order_items"]
        .groupBy("seller_id")
        .agg(F.count("*").alias("n"), F.sum("price").alias("total"))
    )
    return sellers.join(per_seller, "seller_id", "left").select(
        "seller_id",
        F.coalesce("n", F.lit(0)).alias("items_sold"),
        F.coalesce(F.col("total").cast("double"), F.lit(0.0)).alias("revenue"),
    )


# -- aggregation -----------------------------------------------------------------------


@case("a01_count_by_key", "SELECT customer_id, count(*) AS orders FROM c_orders GROUP BY 1")
def _(t):
    return t["orders"].groupBy("customer_id").agg(F.count("*").alias("orders"))


@case(
    "a02_sum_and_mean",
    """SELECT product_id, CAST(sum(price) AS DOUBLE) AS total, CAST(sum(price) AS DOUBLE) / count(*) AS mean
    FROM c_order_items GROUP BY 1""",
)
def _(t):
    sums = t["order_items"].groupBy("product_id").agg(
        F.sum("price").alias("total"), F.count("price").alias("n")
    )
    return sums.select(
        "product_id",
        F.col("total").cast("double").alias("total"),
        (F.col("total").cast("double") / F.col("n")).alias("mean"),
    )


@case(
    "a03_count_matched",
    """SELECT o.order_id, count(r.review_id) AS reviews FROM c_orders o LEFT JOIN c_order_reviews r USING (order_id) GROUP BY 1""",
)
def _(t):
    joined = joins.lookup_unwound(
        t["orders"].select("order_id"),
        t["order_reviews"].select("order_id", "review_id"),
        "order_id",
        "order_id",
    )
    return joined.groupBy("order_id").agg(F.count("review_id").alias("reviews"))


@case(
    "a04_distinct_count",
    """SELECT seller_id, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products FROM c_order_items GROUP BY 1""",
)
def _(t):
    return (
        t["order_items"]
        .groupBy("seller_id")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("product_id").alias("products"),
        )
    )


@case("a05_max_per_group", "SELECT customer_id, max(order_purchase_timestamp) AS latest FROM c_orders GROUP BY 1")
def _(t):
    return t["orders"].groupBy("customer_id").agg(F.max("order_purchase_timestamp").alias("latest"))


@case(
    "a06_sorted_distinct_list",
    "SELECT order_id, array_to_string(payment_types, ',') AS payment_types FROM c_payment_summaries",
)
def _(t):
    return (
        t["order_payments"]
        .groupBy("order_id")
        .agg(F.concat_ws(",", aggregates.sorted_set("payment_type")).alias("payment_types"))
    )


@case(
    "a08_composite_group",
    """SELECT order_status, CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS month, count(*) AS orders
    FROM c_orders GROUP BY 1, 2""",
)
def _(t):
    from storelens.functions.scalars import month_start

    orders = t["orders"]
    return orders.groupBy(
        "order_status", month_start(orders, "order_purchase_timestamp").alias("month")
    ).agg(F.count("*").alias("orders"))


@case(
    "a09_whole_table",
    """SELECT count(*) AS rows, CAST(sum(price) AS DOUBLE) AS total, max(shipping_limit_date) AS latest FROM c_order_items""",
)
def _(t):
    return t["order_items"].agg(
        F.count("*").alias("rows"),
        F.sum("price").cast("double").alias("total"),
        F.max("shipping_limit_date").alias("latest"),
    )


@case(
    "a10_bucket_groups",
    """SELECT CASE WHEN l_linenumber >= 1 AND l_linenumber < 3 THEN '1' WHEN l_linenumber >= 3 AND l_linenumber < 5 THEN '3'
    ELSE 'other' END AS bucket, count(*) AS items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units FROM lineitem GROUP BY 1""",
)
def _(t):
    return aggregates.bucket_groups(
        t.star("lineitem"),
        "l_linenumber",
        [1, 3, 5],
        [F.count("*").alias("items"), F.sum(F.col("l_quantity").cast("bigint")).alias("units")],
    )


@case(
    "a11_facets",
    """WITH g AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
    SELECT * FROM (SELECT 'top' AS facet, event_type, n FROM g ORDER BY n DESC, event_type LIMIT 3)
    UNION ALL SELECT 'total', NULL, CAST(sum(n) AS BIGINT) FROM g""",
)
def _(t):
    grouped = t.star("events").groupBy("event_type").agg(F.count("*").alias("n"))
    return aggregates.facet(
        grouped,
        {
            "top": lambda g: paging.top_n(g, 3, F.col("n").desc(), F.col("event_type")),
            "total": lambda g: g.agg(F.sum("n").alias("n")),
        },
    )


@case(
    "a12_value_counts",
    "SELECT l_orderkey, count(*) AS rows FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def _(t):
    return aggregates.value_counts(t.star("lineitem"), "l_orderkey", more_than=1)


@case(
    "a13_share_of_total",
    """SELECT event_type, count(*) AS rows,
    """
    + half_even("count(*) * 100", "(SELECT count(*) FROM events)", 2)
    + """ AS percentage FROM events GROUP BY 1""",
)
def _(t):
    return aggregates.share_of_total(t.star("events"), ["event_type"])


@case(
    "a14_describe",
    """SELECT 'l_quantity' AS "column", count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std,
    min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem UNION ALL
    SELECT 'l_linenumber', count(l_linenumber), round(avg(l_linenumber), 6), round(stddev_samp(l_linenumber), 6),
    min(l_linenumber), max(l_linenumber) FROM lineitem""",
)
def _(t):
    out = aggregates.describe(t.star("lineitem"), ["l_quantity", "l_linenumber"])
    return out.select("column", "count", dbl("mean"), dbl("std"), "min", "max")


@case(
    "a14_quartiles",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
        round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice")
    ),
)
def _(t):
    out = aggregates.describe(t.star("lineitem"), ["l_quantity", "l_extendedprice"])
    return out.select("column", dbl("q25"), dbl("q50"), dbl("q75"))


_A15 = """SELECT customer_id, order_id, order_purchase_timestamp, order_status FROM c_orders
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_purchase_timestamp {dir}, order_id {dir}) = 1"""


@case("a15_first_per_key", _A15.format(dir="ASC"))
def _(t):
    return aggregates.first_row_per_key(
        t["orders"].drop("metadata"), ["customer_id"], ["order_purchase_timestamp", "order_id"]
    )


@case("a15_last_per_key", _A15.format(dir="DESC"))
def _(t):
    return aggregates.last_row_per_key(
        t["orders"].drop("metadata"), ["customer_id"], ["order_purchase_timestamp", "order_id"]
    )


# -- sorting, paging, unions -----------------------------------------------------------


@case(
    "o01_mixed_sort",
    """SELECT product_id, product_category_name, product_width_cm, row_number() OVER
    (ORDER BY product_category_name ASC NULLS LAST, product_width_cm DESC NULLS FIRST, product_id) AS place
    FROM c_products""",
)
def _(t):
    """All rows in order; places are counted category by category, so no task numbers all rows."""
    rows = t["products"].select("product_id", "product_category_name", "product_width_cm")
    inner = [paging.newest_first("product_width_cm"), paging.oldest_first("product_id")]
    outer = paging.oldest_first("product_category_name")
    per_category = Window.partitionBy("product_category_name").orderBy(*inner)
    sizes = rows.groupBy(F.col("product_category_name").alias("of")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy(F.col("of").asc_nulls_last())) - F.col("n")
    begins = sizes.select("of", before.alias("before"))
    placed = rows.withColumn("i", F.row_number().over(per_category)).join(
        begins, F.col("product_category_name").eqNullSafe(F.col("of"))
    )
    out = placed.withColumn("place", (F.col("before") + F.col("i")).cast("bigint"))
    return out.orderBy(outer, *inner).select(
        "product_id", "product_category_name", "product_width_cm", "place"
    )


@case(
    "o02_sort_by_aggregate",
    "SELECT customer_id, count(*) AS orders FROM c_orders GROUP BY 1 ORDER BY 2 DESC, 1",
)
def _(t):
    counted = t["orders"].groupBy("customer_id").agg(F.count("*").alias("orders"))
    return counted.orderBy(paging.newest_first("orders"), paging.oldest_first("customer_id"))


@case(
    "o03_top_n",
    "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 15",
)
def _(t):
    return paging.top_n(
        t.star("events").select("event_id", "value"),
        15,
        paging.newest_first("value"),
        paging.oldest_first("event_id"),
    )


@case("o04_offset_page", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY 1 LIMIT 24 OFFSET 500")
def _(t):
    return paging.offset_page(
        t.star("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 500, 24
    )


@case("o05_keyset_page", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 499 ORDER BY 1 LIMIT 24")
def _(t):
    return paging.keyset_page(
        t.star("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 499, 24
    )


@case(
    "o06_nearest_first",
    "SELECT geolocation_zip_code_prefix AS zip, geolocation_city AS city, geolocation_state AS state FROM c_geolocations "
    "ORDER BY round("
    + _SPHERE.format(lat1="geolocation_lat", lng1="geolocation_lng", lat2="-30.03::DOUBLE", lng2="-51.23::DOUBLE")
    + ", 3), 1, 2, 3 LIMIT 20",
)
def _(t):
    found = nearest(
        t["geolocations"],
        "geolocation_lat",
        "geolocation_lng",
        -30.03,
        -51.23,
        20,
        ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"],
    )
    return found.select(
        F.col("geolocation_zip_code_prefix").alias("zip"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
    )


@case(
    "o07_page_then_aggregate",
    """SELECT s.seller_id, count(i.seller_id) AS items_sold FROM (SELECT seller_id FROM c_sellers ORDER BY 1 LIMIT 10) s
    LEFT JOIN c_order_items i USING (seller_id) GROUP BY 1""",
)
def _(t):
    return lookups.seller_sales(t, 10).drop("revenue")


@case(
    "u01_labelled_union",
    """SELECT 'order' AS kind, o_orderkey AS id FROM orders UNION ALL SELECT 'event', event_id FROM events""",
)
def _(t):
    return aggregates.labelled_union(
        {
            "order": t.star("orders").select(F.col("o_orderkey").alias("id")),
            "event": t.star("events").select(F.col("event_id").alias("id")),
        }
    )


@case(
    "z01_compare_runs",
    """SELECT coalesce(b.p, a.p) AS query, b.n AS execution_time_ms_before, a.n AS execution_time_ms_after,
    CASE WHEN b.n IS NULL OR a.n IS NULL OR b.n = 0 THEN NULL ELSE """
    + half_even("(b.n - a.n) * 100", "b.n", 2)
    + """ END AS improvement_percent
    FROM (SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b
    FULL JOIN (SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a ON a.p = b.p""",
)
def _(t):
    def run(status):
        return (
            t.star("orders")
            .filter(F.col("o_orderstatus") == status)
            .groupBy(F.col("o_orderpriority").alias("query"))
            .agg(F.count("*").alias("execution_time_ms"))
        )

    return comparison.compare_runs(run("O"), run("F"))
