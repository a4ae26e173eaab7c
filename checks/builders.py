"""Document builders, flattened again for the comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.bindings import half_even
from checks.catalog import case
from storelens.plans import documents

AS_OF = "2018-10-17"


@case("d01_products_catalog", "SELECT * FROM c_products_catalog ")
def _(t):
    docs = documents.products_catalog(t)
    return docs.select("product_id", "category.*", "metrics.*", "dimensions.*")


@case("d02_order_reviews", "SELECT * FROM c_order_reviews ")
def _(t):
    return documents.order_reviews(t)


@case(
    "d03_orders_analytics",
    """SELECT order_id, status, purchase_ts, purchase_year_month, customer_id, customer_unique_id, state, city,
    zip_code_prefix, CAST(total_value AS DOUBLE) AS total_value, payment_types, max_installments FROM c_orders_analytics""",
)
def _(t):
    docs = documents.orders_analytics(t)
    return docs.select(
        "order_id",
        "status",
        "purchase_ts",
        "purchase_year_month",
        "customer.*",
        F.col("payment_summary.total_value").cast("double").alias("total_value"),
        F.concat_ws(",", "payment_summary.payment_types").alias("payment_types"),
        "payment_summary.max_installments",
    )


@case(
    "d04_seller_state_buckets",
    """SELECT seller_state AS state, count(*) AS seller_count, count(*) AS state_sellers, string_agg(seller_id || ' ' || seller_city || ' ' || seller_zip_code_prefix,
    ',' ORDER BY seller_id) AS sellers FROM c_sellers GROUP BY 1""",
)
def _(t):
    """States in up to four documents, their sellers put together again."""
    docs = documents.seller_state_buckets(t, buckets=4)
    whole = docs.groupBy("state").agg(
        F.max("seller_count").alias("seller_count"), F.max("state_sellers").alias("state_sellers"), F.array_sort(F.flatten(F.collect_list("sellers"))).alias("sellers")
    )
    shown = F.transform("sellers", lambda s: F.concat_ws(" ", s["seller_id"].cast("string"), s["city"], s["zip_code_prefix"].cast("string")))
    return whole.withColumn("sellers", F.concat_ws(",", shown))


@case(
    "a07_bucket_sizes",
    "SELECT seller_state AS state, count(*) AS sellers, CAST(sum(seller_id) AS BIGINT) AS id_sum FROM c_sellers GROUP BY 1",
)
def _(t):
    """States in up to five documents, put together again."""
    docs = documents.seller_state_buckets(t, buckets=5)
    return docs.groupBy("state").agg(
        F.sum(F.size("sellers")).alias("sellers"),
        F.sum(
            F.aggregate("sellers", F.lit(0).cast("bigint"), lambda a, s: a + s["seller_id"])
        ).alias("id_sum"),
    )


@case(
    "d06_enriched_catalog",
    f"""SELECT e.product_id, 'Producto ' || upper(e.category[1]) || lower(e.category[2:]) || ' - ' || left(CAST(e.product_id AS VARCHAR), 5) AS name, e.category, e.price,
    'https://images.example/' || e.product_id || '_1.jpg' AS photos, e.units, e.rating, e.name_length, CAST(p.product_description_lenght AS BIGINT) AS description_length, e.photos_qty,
    e.weight_g, p.product_length_cm AS length_cm, p.product_height_cm AS height_cm, e.width_cm, CAST(TIMESTAMP '{AS_OF}' AS VARCHAR) AS created_at
    FROM c_enriched_catalog e JOIN c_products p USING (product_id)""",
)
def _(t):
    docs = documents.enriched_catalog(t, F.lit(AS_OF).cast("timestamp"))
    spec = lambda name: F.col("specifications")[name].cast("bigint").alias(name)
    return docs.select(
        "product_id",
        "name",
        "category",
        "price",
        F.concat_ws(",", "photos").alias("photos"),
        F.col("computed_metrics.total_units_sold").alias("units"),
        F.col("computed_metrics.average_rating").alias("rating"),
        *(spec(n) for n in ("name_length", "description_length", "photos_qty")),
        "dimensions.*",
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
    )


_PERSON = """SELECT c.customer_unique_id, coalesce(max(o.order_purchase_timestamp), TIMESTAMP '2018-10-17') AS last_session_date
    FROM (SELECT * FROM c_customers {keep}) c LEFT JOIN c_orders o USING (customer_id) GROUP BY 1"""


@case(
    "d07_customer_behavior",
    _PERSON.format(
        keep="QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id) = 1"
    ),
)
def _(t):
    return documents.customer_behavior(t, F.lit(AS_OF).cast("timestamp_ntz"))


@case("d07_customer_behavior_all_ids", _PERSON.format(keep=""))
def _(t):
    return documents.customer_behavior(t, F.lit(AS_OF).cast("timestamp_ntz"), all_ids=True)


@case(
    "d08_seller_metrics",
    "SELECT i.seller_id, " + half_even("sum(score_sum)", "nullif(sum(score_count), 0)", 1) + """ AS reputation_score, '2018-08' AS period,
    CAST(sum(i.sales) AS DOUBLE) AS total_sales, count(*) AS orders, """
    + half_even("sum(date_diff('second', o.order_delivered_carrier_date, o.order_delivered_customer_date))", "(count(o.order_delivered_customer_date) * 3600)", 1)
    + """ AS avg_shipping_hours FROM (SELECT seller_id, order_id, sum(price) AS sales FROM c_order_items GROUP BY 1, 2) i
    LEFT JOIN c_orders_delivered o USING (order_id) LEFT JOIN c_order_scores s USING (order_id) GROUP BY 1""",
)
def _(t):
    docs = documents.seller_metrics(t.replacing(orders=t["orders_delivered"]))
    return docs.select(
        "seller_id", "reputation_score", "kpis.period", F.col("kpis.total_sales").cast("double").alias("total_sales"), "kpis.orders", "kpis.avg_shipping_hours"
    )


@case(
    "d09_review_documents",
    """SELECT review_id, order_id, review_score, review_comment_title AS title, review_comment_message AS message,
    date_trunc('milliseconds', review_creation_date) AS created,
    date_trunc('milliseconds', review_answer_timestamp) AS answered FROM c_order_reviews""",
)
def _(t):
    docs = documents.review_documents(t)
    parsed = docs.select("review_id", F.parse_json("document").alias("d"))
    text = lambda name: F.try_variant_get("d", f"$.{name}", "string")
    return parsed.select(
        "review_id",
        text("order_id").cast("bigint").alias("order_id"),
        F.variant_get("d", "$.review_score", "int").alias("review_score"),
        text("review_comment_title").alias("title"),
        text("review_comment_message").alias("message"),
        text("review_creation_date").cast("timestamp").cast("timestamp_ntz").alias("created"),
        text("review_answer_timestamp").cast("timestamp").cast("timestamp_ntz").alias("answered"),
    )


@case(
    "d10_zip_dimension",
    "SELECT zip_code_prefix, city, state, latitude, longitude FROM c_geo_locations",
)
def _(t):
    return t["geo_locations"].select(
        "zip_code_prefix",
        "city",
        "state",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
    )


@case(
    "d10_category_dimension",
    """SELECT row_number() OVER (ORDER BY p_name) AS category_id, p_name AS name_pt, min(p_type) AS name_en FROM part GROUP BY p_name""",
)
def _(t):
    return documents.category_dimension(t.star("part"), "p_name", "p_type")
