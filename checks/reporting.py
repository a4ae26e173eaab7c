"""Named reports, lookups, rewrites and document reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.bindings import half_even
from checks.catalog import case, dbl
from storelens.plans import collections as col_reports
from storelens.plans import documents, lookups, reports

LO, HI = "1997-01-01", "1998-01-01"

_N1 = """SELECT c.customer_state, CAST(date_trunc('month', o.order_purchase_timestamp) AS TIMESTAMP) AS purchase_month,
    count(*) AS total_orders FROM c_orders o JOIN c_customers c USING (customer_id)
    WHERE o.order_status = 'F' AND o.order_purchase_timestamp >= TIMESTAMP '1997-01-01'
    AND o.order_purchase_timestamp < TIMESTAMP '1998-01-01' GROUP BY 1, 2"""


@case("n01_orders_by_state_month", _N1)
def _(t):
    return reports.orders_by_state_month(t, "F", LO, HI)


@case(
    "n02_payments_by_type",
    """SELECT payment_type, count(*) AS total_payments, CAST(sum(payment_value) AS DOUBLE) AS total_value,
    -- half-up at the sixth place, as the decimal mean has it
    CAST((2 * CAST(sum(payment_value) * 1000000 AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000 AS avg_value
    FROM c_order_payments WHERE payment_value > 0 GROUP BY 1""",
)
def _(t):
    return reports.payments_by_type(t).select(
        "payment_type", "total_payments", dbl("total_value"), dbl("avg_value")
    )


@case(
    "n03_late_deliveries",
    """SELECT c.customer_state, count(*) AS late_orders FROM c_orders_delivered o
    JOIN c_customers c USING (customer_id)
    WHERE o.order_delivered_customer_date > o.order_estimated_delivery_date GROUP BY 1""",
)
def _(t):
    return reports.late_deliveries(t.replacing(orders=t["orders_delivered"]))


@case(
    "n04_city_search",
    """SELECT geolocation_city, geolocation_state, count(*) AS points FROM c_geolocations
    WHERE strip_accents(geolocation_city) ILIKE strip_accents('%mâchin%') GROUP BY 1, 2""",
)
def _(t):
    return reports.city_search(t, "mâchin")


_GEODESIC = """{name} AS (
    WITH RECURSIVE ends AS (
        SELECT *, atan((1 - 1/298.257223563) * tan(radians(lat1))) AS u1,
               atan((1 - 1/298.257223563) * tan(radians(lat2))) AS u2, radians(lng2 - lng1) AS d FROM {src}),
    steps AS (
        SELECT id, d AS lam, 0 AS i FROM ends
        UNION ALL
        SELECT s.id, e.d + (1 - c) * f * sin_a * (sig + c * sin_s * (mid + c * cos_s * (2 * mid * mid - 1))), i + 1
        FROM (SELECT *, f / 16 * cos2_a * (4 + f * (4 - 3 * cos2_a)) AS c FROM (
            SELECT *, CASE WHEN abs(cos2_a) < 1e-15 THEN 0 ELSE cos_s - 2 * sin(u1) * sin(u2) / cos2_a END AS mid,
                   1/298.257223563 AS f FROM (
            SELECT *, 1 - sin_a * sin_a AS cos2_a, atan2(sin_s, cos_s) AS sig FROM (
            SELECT *, CASE WHEN sin_s = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / sin_s END AS sin_a FROM (
            SELECT e2.*, st.lam, st.i, sqrt(pow(cos(u2) * sin(lam), 2)
                     + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS sin_s,
                   sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cos_s
            FROM steps st JOIN ends e2 USING (id) WHERE st.i < 15))))) s JOIN ends e USING (id)),
    arcs AS (
        SELECT *, cos2_a * (6378137.0 * 6378137.0 - b * b) / (b * b) AS uu FROM (
        SELECT *, CASE WHEN abs(cos2_a) < 1e-15 THEN 0 ELSE cos_s - 2 * sin(u1) * sin(u2) / cos2_a END AS mid,
               6378137.0 * (1 - 1/298.257223563) AS b FROM (
        SELECT *, 1 - sin_a * sin_a AS cos2_a, atan2(sin_s, cos_s) AS sig FROM (
        SELECT *, CASE WHEN sin_s = 0 THEN 0 ELSE cos(u1) * cos(u2) * sin(lam) / sin_s END AS sin_a FROM (
        SELECT e2.*, st.lam, sqrt(pow(cos(u2) * sin(lam), 2)
                 + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS sin_s,
               sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cos_s
        FROM steps st JOIN ends e2 USING (id) WHERE st.i = 15))))),
    series AS (SELECT *, 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu))) AS big_a,
        uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu))) AS big_b FROM arcs)
    SELECT *, b * big_a * (sig - big_b * sin_s * (mid + big_b / 4 * (cos_s * (2 * mid * mid - 1)
        - big_b / 6 * mid * (4 * sin_s * sin_s - 3) * (4 * mid * mid - 3)))) AS metres FROM series)"""

_SPHERE = """2 * ((2 * 6378137.0::DOUBLE + 6378137.0::DOUBLE * (1 - 1/298.257223563::DOUBLE)) / 3) * asin(sqrt(least(1.0,
    pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)
    + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2))))"""

_NEAR = (
    """SELECT * FROM (WITH near AS (SELECT row_number() OVER () AS id, geolocation_zip_code_prefix,
    geolocation_city, geolocation_state, geolocation_lat AS lat1, geolocation_lng AS lng1,
    -23.5505::DOUBLE AS lat2, -46.6333::DOUBLE AS lng2 FROM (SELECT * FROM c_geolocations
    ORDER BY round("""
    + _SPHERE.format(lat1="geolocation_lat", lng1="geolocation_lng", lat2="-23.5505::DOUBLE", lng2="-46.6333::DOUBLE")
    + """, 3), 1, 4, 5 LIMIT 20)),
    """
    + _GEODESIC.format(name="measured", src="near")
    + """ SELECT geolocation_zip_code_prefix, geolocation_city, geolocation_state,
    round(metres, 2) AS distance_meters FROM measured)"""
)


@case("n05_nearest_points", _NEAR)
def _(t):
    return reports.nearest_points(t).withColumn("distance_meters", F.round("distance_meters", 2))


@case(
    "n06_products_with_spec",
    """SELECT product_id, product_specifications FROM c_products
    WHERE json_extract_string(product_specifications, '$.logistics.weight_class') = 'heavy'""",
)
def _(t):
    return reports.products_with_spec(t)


@case(
    "n06b_products_with_two_specs",
    """SELECT product_id, product_specifications FROM c_products
    WHERE CAST(json_extract(product_specifications, '$.warranty_months') AS INTEGER) = 10
    AND json_extract_string(product_specifications, '$.logistics.fragile') = 'true'""",
)
def _(t):
    return reports.products_with_spec(t, {"warranty_months": 10, "logistics": {"fragile": True}})


@case(
    "n07_products_with_token",
    """SELECT product_id, array_to_string(search_tokens, ',') AS search_tokens FROM c_products
    WHERE list_contains(search_tokens, 'gizmo')""",
)
def _(t):
    return reports.products_with_token(t, ["gizmo"]).withColumn(
        "search_tokens", F.concat_ws(",", "search_tokens")
    )


@case(
    "n08_active_promotions",
    """SELECT promotion_id, product_id, CAST(discount_percentage AS DOUBLE) AS discount_percentage
    FROM c_product_promotions WHERE period_lo <= TIMESTAMP '1998-06-15' AND period_hi > TIMESTAMP '1998-06-15'""",
)
def _(t):
    return reports.active_promotions(t, "1998-06-15").withColumn(
        "discount_percentage", F.col("discount_percentage").cast("double")
    )


def _grams(text: str) -> str:
    """Distinct padded 3-grams of a text, as a DuckDB list."""
    return (
        "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower("
        + text
        + "), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), "
        "lambda i: substring('  ' || w || ' ', i, 3)))))"
    )


def _similar(a: str, b: str) -> str:
    """Similarity of two gram lists, as a double."""
    return (
        f"(len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))))"
    )


@case(
    "n09_category_fuzzy",
    f"""SELECT category_id, name_en, round(score, 6) AS score FROM (SELECT *, {_similar('g', 'q')} AS score
    FROM (SELECT category_id, name_en, {_grams('name_en')} AS g, {_grams("'smal gizmos'")} AS q FROM c_categories))
    WHERE score >= 0.3""",
)
def _(t):
    return reports.category_fuzzy(t, "smal gizmos").withColumn("score", F.round("score", 6))


@case(
    "n10_zip_distance",
    "SELECT * FROM (WITH pairs AS (SELECT 1 AS id, a.zip_code_prefix AS seller_zip, b.zip_code_prefix AS customer_zip, "
    "a.latitude AS lat1, a.longitude AS lng1, b.latitude AS lat2, b.longitude AS lng2 "
    "FROM c_geo_locations a JOIN c_geo_locations b ON a.zip_code_prefix = 3 AND b.zip_code_prefix = 21), "
    + _GEODESIC.format(name="measured", src="pairs")
    + " SELECT seller_zip, customer_zip, round(metres / 1000, 5) AS distance_km FROM measured)",
)
def _(t):
    return reports.zip_distance(t, 3, 21).withColumn("distance_km", F.round("distance_km", 5))


@case(
    "j09_pair_distances",
    "SELECT * FROM (WITH pairs AS (SELECT row_number() OVER () AS id, * FROM (SELECT DISTINCT i.seller_id AS seller_zip, "
    "c.customer_zip_code_prefix AS customer_zip, CAST(a.latitude AS DOUBLE) AS lat1, CAST(a.longitude AS DOUBLE) AS lng1, CAST(b.latitude AS DOUBLE) AS lat2, "
    "CAST(b.longitude AS DOUBLE) AS lng2 FROM c_order_items i JOIN c_orders o USING (order_id) JOIN c_customers c USING (customer_id) "
    "JOIN c_geo_locations a ON a.zip_code_prefix = i.seller_id JOIN c_geo_locations b ON b.zip_code_prefix = c.customer_zip_code_prefix)), "
    + _GEODESIC.format(name="measured", src="pairs")
    + " SELECT CAST(seller_zip AS INTEGER) AS seller_zip, customer_zip, round(metres / 1000, 5) AS distance_km FROM measured)",
)
def _(t):
    """Every pair of zip prefixes between which something was sold, on the ellipsoid."""
    sold = t["order_items"].select("order_id", F.col("seller_id").cast("int").alias("seller_zip")).join(t["orders"].select("order_id", "customer_id"), "order_id")
    buyers = t["customers"].select("customer_id", F.col("customer_zip_code_prefix").alias("customer_zip"))
    pairs = sold.join(buyers, "customer_id").select("seller_zip", "customer_zip").distinct()
    return reports.pair_distances(pairs, t["geo_locations"]).withColumn("distance_km", F.round("distance_km", 5))


_N11 = """SELECT c.customer_state, CAST(date_trunc('month', o.order_purchase_timestamp) AS TIMESTAMP) AS purchase_month,
    o.order_status, count(*) AS total_orders FROM c_orders o JOIN c_customers c USING (customer_id) GROUP BY 1, 2, 3"""


@case("n11_monthly_summary", _N11)
def _(t):
    return reports.monthly_summary(t)


# -- lookups ---------------------------------------------------------------------------


@case(
    "c01_order_detail",
    """SELECT order_id, customer_id, order_status, order_purchase_timestamp FROM c_orders WHERE order_id = 777""",
)
def _(t):
    return lookups.order_detail(t, 777).drop("metadata")


@case(
    "c02_customer_history",
    """SELECT o.order_id, o.order_status, o.order_purchase_timestamp FROM c_orders o
    JOIN c_customers c USING (customer_id) WHERE c.customer_unique_id = 61
    ORDER BY o.order_purchase_timestamp DESC, o.order_id LIMIT 20""",
)
def _(t):
    return lookups.customer_history(t, 61)


@case(
    "c03_order_tracking",
    """SELECT order_status, order_delivered_customer_date, order_estimated_delivery_date
    FROM c_orders_delivered WHERE order_id = 777""",
)
def _(t):
    return lookups.order_tracking(t.replacing(orders=t["orders_delivered"]), 777)


@case(
    "c04_seller_items",
    """SELECT i.order_id, i.product_id, CAST(i.price AS DOUBLE) AS price, o.order_status, o.order_purchase_timestamp
    FROM c_order_items i JOIN c_orders o USING (order_id) WHERE i.seller_id = 7
    ORDER BY o.order_purchase_timestamp DESC, i.order_id, i.order_item_id, i.product_id, i.price LIMIT 50""",
)
def _(t):
    found = lookups.seller_items(t.replacing(order_items=t["order_items_dated"]), 7)
    return found.withColumn("price", F.col("price").cast("double"))


@case(
    "c05_catalog_page",
    """SELECT product_id, product_category_name, product_weight_g FROM c_products WHERE category_id = 11
    ORDER BY product_id LIMIT 24""",
)
def _(t):
    return lookups.catalog_page(t, 11)


@case(
    "c06_product_promotions",
    """SELECT promotion_id, CAST(discount_percentage AS DOUBLE) AS discount_percentage FROM c_product_promotions
    WHERE product_id = 36 AND period_lo <= TIMESTAMP '1996-01-15' AND period_hi > TIMESTAMP '1996-01-15'""",
)
def _(t):
    return reports.active_promotions(t, "1996-01-15", 36).select(
        "promotion_id", F.col("discount_percentage").cast("double").alias("discount_percentage")
    )


@case(
    "c07_awaiting_approval",
    """SELECT order_id, order_purchase_timestamp FROM c_orders WHERE order_status = 'P'
    ORDER BY order_purchase_timestamp, order_id LIMIT 100""",
)
def _(t):
    return lookups.awaiting_approval(t, "P")


@case(
    "c08_pending_events",
    """SELECT event_id, payload FROM c_outbox_events WHERE processed_at IS NULL
    ORDER BY created_at, event_id LIMIT 100""",
)
def _(t):
    return lookups.pending_events(t)


# -- rewrites --------------------------------------------------------------------------

_B1 = """SELECT s.seller_id, count(i.seller_id) AS items_sold, CAST(coalesce(sum(i.price), 0) AS DOUBLE) AS revenue
    FROM (SELECT seller_id FROM c_sellers ORDER BY seller_id LIMIT 100) s
    LEFT JOIN c_order_items i ON i.seller_id = s.seller_id GROUP BY 1"""


@case("b1_seller_sales", _B1)
def _(t):
    return lookups.seller_sales(t).withColumn("revenue", F.col("revenue").cast("double"))


@case("b1_seller_sales_correlated", _B1)
def _(t):
    return lookups.seller_sales_correlated(t).withColumn("revenue", F.col("revenue").cast("double"))


_B2 = """SELECT order_status, count(*) AS orders FROM c_orders WHERE order_purchase_timestamp >= TIMESTAMP '1997-06-10'
    AND order_purchase_timestamp < TIMESTAMP '1997-06-11' GROUP BY 1"""


@case("b2_status_of_day", _B2)
def _(t):
    return lookups.status_of_day(t, "1997-06-10")


@case("b2_status_of_day_truncated", _B2)
def _(t):
    return lookups.status_of_day_truncated(t, "1997-06-10")


_B3 = """SELECT count(*) AS orders FROM c_orders o WHERE o.order_status = 'F'
    AND o.order_purchase_timestamp >= TIMESTAMP '1997-06-10' AND o.order_purchase_timestamp < TIMESTAMP '1997-06-11'
    AND NOT EXISTS (SELECT 1 FROM c_order_reviews r WHERE r.order_id = o.order_id)"""


@case("b3_delivered_without_review", _B3)
def _(t):
    return lookups.delivered_without_review(t, "1997-06-10", "F")


@case(
    "b3_delivered_without_review_not_in",
    """SELECT count(*) AS orders FROM c_orders o WHERE o.order_status = 'F'
    AND o.order_purchase_timestamp >= TIMESTAMP '1997-06-10' AND o.order_purchase_timestamp < TIMESTAMP '1997-06-11'
    AND o.order_id NOT IN (SELECT order_id FROM c_order_reviews)""",
)
def _(t):
    return lookups.delivered_without_review_not_in(t, "1997-06-10", "F")


@case(
    "b4_deep_page_offset",
    "SELECT product_id, product_category_name FROM c_products ORDER BY product_id LIMIT 24 OFFSET 150",
)
def _(t):
    return lookups.deep_page_offset(t, 150)


@case(
    "b4_deep_page_keyset",
    "SELECT product_id, product_category_name FROM c_products WHERE product_id > 149 ORDER BY product_id LIMIT 24",
)
def _(t):
    return lookups.deep_page_keyset(t, 149)


_B5 = """SELECT count(*) AS orders FROM c_orders WHERE order_purchase_timestamp >= TIMESTAMP '1997-06-01'
    AND order_purchase_timestamp < TIMESTAMP '1997-07-01'"""


@case("b5_month_count_flat", _B5)
def _(t):
    return lookups.month_count(t["orders"], "1997-06")


@case(
    "b6_orders_with_metadata",
    "SELECT order_id FROM c_orders WHERE gift AND channel = '1-URGENT'",
)
def _(t):
    return reports.orders_with_metadata(t, {"gift": True, "channel": "1-URGENT"})


# -- document reports ------------------------------------------------------------------


@case(
    "m01_revenue_top_and_summary",
    """SELECT * FROM (SELECT 'top_states' AS facet, state, month, total_orders, round(total_revenue, 2) AS total_revenue,
    avg_review_score FROM c_revenue_groups ORDER BY total_revenue DESC, state, month LIMIT 10)
    UNION ALL SELECT 'summary', NULL, NULL, CAST(sum(total_orders) AS BIGINT),
    round(CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE), 2), round(avg(avg_review_score), 6) FROM c_revenue_groups""",
)
def _(t):
    out = col_reports.revenue_by_state_month(
        documents.orders_analytics(t),
        documents.order_reviews(t),
        "F",
        LO,
        HI,
    )
    return out.select(
        "facet", "state", "month", "total_orders", dbl("total_revenue", 2), dbl("avg_review_score")
    )


@case(
    "m01_revenue_groups",
    "SELECT state, month, total_orders, total_revenue, avg_review_score FROM c_revenue_groups",
)
def _(t):
    out = col_reports.revenue_groups(
        documents.orders_analytics(t), documents.order_reviews(t), "F", LO, HI
    )
    return out.select("state", "month", "total_orders", dbl("total_revenue", 2), dbl("avg_review_score"))


@case(
    "m01b_revenue_plain",
    "SELECT state, month, total_orders, total_revenue FROM c_revenue_groups",
)
def _(t):
    out = col_reports.revenue_plain(
        documents.orders_analytics(t), documents.order_reviews(t), "F", LO, HI
    )
    return out.withColumn("total_revenue", dbl("total_revenue", 2))


_M2 = """SELECT CAST(review_score AS VARCHAR) AS bucket, count(*) AS total_reviews,
    CAST(sum(length(review_comment_message)) AS DOUBLE) / count(*) AS avg_comment_length
    FROM {src} WHERE review_score <= 3 AND review_comment_message IS NOT NULL GROUP BY 1"""


@case("m02_low_score_reviews", _M2.format(src="c_order_reviews"))
def _(t):
    return col_reports.low_score_reviews(documents.order_reviews(t))


@case("m02_low_score_texts", _M2.format(src="c_text_reviews"))
def _(t):
    return col_reports.low_score_reviews(t["text_reviews"])


@case(
    "m03_category_attributes",
    """SELECT name_en AS category, 2 * count(*) AS product_count,
    """ + half_even("CAST(sum(weight_g) AS BIGINT)", "count(weight_g)", 2) + """ AS avg_weight,
    """ + half_even("CAST(sum(volume_cm3) AS BIGINT)", "count(volume_cm3)", 2) + """ AS avg_volume
    FROM c_products_catalog WHERE name_en IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
)
def _(t):
    return col_reports.category_attributes(documents.products_catalog(t))


@case(
    "m03_category_attributes_by_product",
    """SELECT name_en AS category, count(*) AS product_count,
    """ + half_even("CAST(sum(weight_g) AS BIGINT)", "count(weight_g)", 2) + """ AS avg_weight,
    """ + half_even("CAST(sum(volume_cm3) AS BIGINT)", "count(volume_cm3)", 2) + """ AS avg_volume
    FROM c_products_catalog WHERE name_en IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
)
def _(t):
    return col_reports.category_attributes_by_product(documents.products_catalog(t))


@case(
    "m04_income_by_rating",
    """SELECT rating, count(*) AS total_photos, CAST(sum(CAST(round(price * units, 2) AS DECIMAL(20,2))) AS DOUBLE)
    / count(*) AS avg_income FROM c_enriched_catalog WHERE category IN ('ECONOMY', 'LARGE') GROUP BY 1""",
)
def _(t):
    return col_reports.income_by_rating(documents.enriched_catalog(t), ("ECONOMY", "LARGE"))


@case(
    "m05_best_sellers",
    """SELECT product_id, category, price, units FROM c_enriched_catalog
    WHERE category IN ('ECONOMY', 'LARGE') AND price < 52000""",
)
def _(t):
    out = col_reports.best_sellers(documents.enriched_catalog(t), ("ECONOMY", "LARGE"), 52000)
    return out.select(
        "product_id", "category", "price", F.col("computed_metrics.total_units_sold").alias("units")
    )
