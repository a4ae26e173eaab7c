"""The commerce tables as views over the star-schema test tables.

``CommerceTables`` gives them as DataFrames; ``CTES`` states the same views in SQL for the
oracle, where each name has a ``c_`` prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.plans.documents import zip_dimension

STAR = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table with a declared schema, so no job is spent on reading footers."""
    return spark.read.schema(STAR[name]).parquet(f"{sf_dir}/{name}.parquet")


class CommerceTables(dict):
    """Table name to DataFrame; a table is put together when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = getattr(self, f"_{name}")()
        return self[name]

    def star(self, name: str) -> DataFrame:
        return star(self.spark, self.sf_dir, name)

    def replacing(self, **tables: DataFrame) -> "CommerceTables":
        other = CommerceTables(self.spark, self.sf_dir)
        other.update(tables)
        return other

    def _orders(self) -> DataFrame:
        return self.star("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.to_json(
                F.struct(
                    F.col("o_orderpriority").alias("channel"),
                    (F.col("o_totalprice") > 250000).alias("gift"),
                )
            ).alias("metadata"),
        )

    def _orders_delivered(self) -> DataFrame:
        """Orders with the delivery dates taken from their line items."""
        shipped = (
            self.star("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"))
            .agg(
                F.min("l_shipdate").alias("order_delivered_carrier_date"),
                F.max("l_shipdate").alias("order_delivered_customer_date"),
            )
        )
        return (
            self["orders"]
            .join(shipped, "order_id", "left")
            .withColumn("order_approved_at", F.col("order_delivered_carrier_date"))
            .withColumn(
                "order_estimated_delivery_date",
                F.col("order_purchase_timestamp") + F.expr("INTERVAL 60 DAY"),
            )
        )

    def _nations(self) -> DataFrame:
        return self.star("nation").select("n_nationkey", "n_name")

    def _customers(self) -> DataFrame:
        return (
            self.star("customer")
            .join(self["nations"], F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.expr("(c_custkey * 62) DIV 100").alias("customer_unique_id"),
                F.expr("CAST(c_custkey DIV 5 AS INT)").alias("customer_zip_code_prefix"),
                F.col("c_mktsegment").alias("customer_city"),
                F.col("n_name").alias("customer_state"),
            )
        )

    def _sellers(self) -> DataFrame:
        return (
            self.star("supplier")
            .join(self["nations"], F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("seller_id"),
                F.col("s_suppkey").cast("int").alias("seller_zip_code_prefix"),
                F.col("s_name").alias("seller_city"),
                F.col("n_name").alias("seller_state"),
            )
        )

    def _geolocations(self) -> DataFrame:
        return (
            self.star("customer")
            .join(self["nations"], F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.expr("CAST(c_custkey DIV 5 AS INT)").alias("geolocation_zip_code_prefix"),
                F.expr("-34 + (c_custkey % 390) / 10D").alias("geolocation_lat"),
                F.expr("-74 + (c_custkey % 400) / 10D").alias("geolocation_lng"),
                F.col("c_mktsegment").alias("geolocation_city"),
                F.col("n_name").alias("geolocation_state"),
            )
        )

    def _geo_locations(self) -> DataFrame:
        return zip_dimension(
            self["geolocations"],
            ["geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"],
        )

    def _products(self) -> DataFrame:
        return self.star("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_size").alias("category_id"),
            F.expr("nullif(p_type, 'PROMO')").alias("product_category_name"),
            F.expr("CAST(length(p_name) AS DOUBLE)").alias("product_name_lenght"),
            F.expr("CAST(length(p_brand) AS DOUBLE)").alias("product_description_lenght"),
            F.expr("CAST(nullif(p_size % 4, 0) AS DOUBLE)").alias("product_photos_qty"),
            F.expr("p_size * 40D").alias("product_weight_g"),
            F.expr("CAST(p_size AS DOUBLE)").alias("product_length_cm"),
            F.expr("CAST(p_size % 7 AS DOUBLE)").alias("product_height_cm"),
            F.expr("CAST(nullif(p_size % 5, 0) AS DOUBLE)").alias("product_width_cm"),
            F.expr(
                "to_json(named_struct('logistics', named_struct('weight_class', "
                "CASE WHEN p_size > 25 THEN 'heavy' ELSE 'light' END, 'fragile', p_size % 10 = 0), "
                "'warranty_months', p_size % 25))"
            ).alias("product_specifications"),
            F.split("p_name", " ").alias("search_tokens"),
        )

    def _product_categories(self) -> DataFrame:
        return self.star("part").select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english"),
        )

    def _categories(self) -> DataFrame:
        return self.star("part").select(
            F.col("p_partkey").alias("category_id"),
            F.col("p_type").alias("name_pt"),
            F.col("p_name").alias("name_en"),
        )

    def _order_items(self) -> DataFrame:
        return self.star("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
            F.col("l_quantity").cast("decimal(12,2)").alias("freight_value"),
        )

    def _order_items_dated(self) -> DataFrame:
        """Items that carry their order's purchase time, for joins on both keys."""
        return self["order_items"].join(
            self["orders"].select("order_id", "order_purchase_timestamp"), "order_id"
        )

    def _order_payments(self) -> DataFrame:
        return self.star("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.col("l_returnflag").alias("payment_type"),
            F.col("l_quantity").cast("int").alias("payment_installments"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("payment_value"),
        )

    def _order_reviews(self) -> DataFrame:
        """Events as reviews: some orders have two, some one, some none."""
        return self.star("events").select(
            F.col("event_id").alias("review_id"),
            F.expr("(event_id * 3) DIV 4").alias("order_id"),
            F.expr("CAST(1 + floor(value) % 5 AS INT)").alias("review_score"),
            F.expr("nullif(event_type, 'click')").alias("review_comment_title"),
            F.expr("CASE WHEN event_type <> 'view' THEN props END").alias("review_comment_message"),
            F.col("ts").alias("review_creation_date"),
            F.expr("CASE WHEN event_type <> 'error' THEN ts + INTERVAL 1 DAY END").alias(
                "review_answer_timestamp"
            ),
        )

    def _text_reviews(self) -> DataFrame:
        """Documents as reviews, with the whole text as the comment."""
        return self.star("documents").select(
            F.col("doc_id").alias("review_id"),
            F.col("doc_id").alias("order_id"),
            F.expr("CAST(1 + n_chars % 5 AS INT)").alias("review_score"),
            F.col("source").alias("review_comment_title"),
            F.col("text").alias("review_comment_message"),
        )

    def _product_promotions(self) -> DataFrame:
        return self.star("lineitem").select(
            F.expr("l_orderkey * 10 + l_linenumber").alias("promotion_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("period_lo"),
            F.expr("l_shipdate + make_dt_interval(CAST(l_quantity AS INT))").alias("period_hi"),
            F.expr("CAST(l_discount * 100 AS DECIMAL(5,2))").alias("discount_percentage"),
        )

    def _outbox_events(self) -> DataFrame:
        return self.star("events").select(
            "event_id",
            F.lit("user").alias("aggregate_type"),
            F.col("user_id").alias("aggregate_id"),
            "event_type",
            F.col("props").alias("payload"),
            F.col("ts").alias("created_at"),
            F.expr("CASE WHEN event_type <> 'error' THEN ts + INTERVAL 1 HOUR END").alias(
                "processed_at"
            ),
            F.lit(0).alias("retries"),
        )


def half_even(total: str, count: str, places: int) -> str:
    """SQL for ``total / count`` rounded half-even, in whole numbers: no float takes part."""
    n = f"CAST(abs({total}) AS HUGEINT) * {10 ** places}"
    c = f"CAST({count} AS HUGEINT)"
    up = f"2 * (({n}) % {c}) > {c} OR (2 * (({n}) % {c}) = {c} AND (({n}) // {c}) % 2 = 1)"
    return (
        f"(sign({total}) * CAST((({n}) // {c}) + CASE WHEN {up} THEN 1 ELSE 0 END AS DOUBLE) "
        f"/ {10 ** places})"
    )


CTES = {
    "c_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
        o_orderdate AS order_purchase_timestamp, o_orderpriority AS channel, o_totalprice > 250000 AS gift
        FROM orders""",
    "c_orders_delivered": """SELECT o.*, s.carrier AS order_delivered_carrier_date,
        s.delivered AS order_delivered_customer_date, s.carrier AS order_approved_at,
        o.order_purchase_timestamp + INTERVAL 60 DAY AS order_estimated_delivery_date
        FROM c_orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS carrier,
        max(l_shipdate) AS delivered FROM lineitem GROUP BY 1) s ON s.l_orderkey = o.order_id""",
    "c_customers": """SELECT c_custkey AS customer_id, (c_custkey * 62) // 100 AS customer_unique_id,
        CAST(c_custkey // 5 AS INTEGER) AS customer_zip_code_prefix, c_mktsegment AS customer_city,
        n_name AS customer_state FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "c_sellers": """SELECT s_suppkey AS seller_id, CAST(s_suppkey AS INTEGER) AS seller_zip_code_prefix,
        s_name AS seller_city, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "c_geolocations": """SELECT CAST(c_custkey // 5 AS INTEGER) AS geolocation_zip_code_prefix,
        -34 + (c_custkey % 390) / 10.0::DOUBLE AS geolocation_lat,
        -74 + (c_custkey % 400) / 10.0::DOUBLE AS geolocation_lng,
        c_mktsegment AS geolocation_city, n_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "c_geo_locations": """SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_city AS city,
        geolocation_state AS state, geolocation_lat AS latitude, geolocation_lng AS longitude
        FROM c_geolocations QUALIFY row_number() OVER (PARTITION BY geolocation_zip_code_prefix
        ORDER BY geolocation_lat, geolocation_lng, geolocation_city, geolocation_state) = 1""",
    "c_products": """SELECT p_partkey AS product_id, p_size AS category_id,
        nullif(p_type, 'PROMO') AS product_category_name, CAST(length(p_name) AS DOUBLE) AS product_name_lenght,
        CAST(length(p_brand) AS DOUBLE) AS product_description_lenght,
        CAST(nullif(p_size % 4, 0) AS DOUBLE) AS product_photos_qty,
        CAST(p_size * 40 AS DOUBLE) AS product_weight_g, CAST(p_size AS DOUBLE) AS product_length_cm,
        CAST(p_size % 7 AS DOUBLE) AS product_height_cm,
        CAST(nullif(p_size % 5, 0) AS DOUBLE) AS product_width_cm,
        '{"logistics":{"weight_class":"' || CASE WHEN p_size > 25 THEN 'heavy' ELSE 'light' END
        || '","fragile":' || CASE WHEN p_size % 10 = 0 THEN 'true' ELSE 'false' END
        || '},"warranty_months":' || (p_size % 25) || '}' AS product_specifications,
        string_split(p_name, ' ') AS search_tokens FROM part""",
    "c_product_categories": """SELECT DISTINCT p_type AS product_category_name,
        lower(p_type) AS product_category_name_english FROM part""",
    "c_categories": "SELECT p_partkey AS category_id, p_type AS name_pt, p_name AS name_en FROM part",
    "c_order_items": """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
        l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS DECIMAL(12,2)) AS freight_value
        FROM lineitem""",
    "c_order_payments": """SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
        l_returnflag AS payment_type, CAST(l_quantity AS INTEGER) AS payment_installments,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS payment_value FROM lineitem""",
    "c_order_reviews": """SELECT event_id AS review_id, (event_id * 3) // 4 AS order_id,
        CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS INTEGER) AS review_score,
        nullif(event_type, 'click') AS review_comment_title,
        CASE WHEN event_type <> 'view' THEN props END AS review_comment_message,
        ts AS review_creation_date,
        CASE WHEN event_type <> 'error' THEN ts + INTERVAL 1 DAY END AS review_answer_timestamp FROM events""",
    "c_text_reviews": """SELECT doc_id AS review_id, doc_id AS order_id,
        CAST(1 + n_chars % 5 AS INTEGER) AS review_score, source AS review_comment_title,
        text AS review_comment_message FROM documents""",
    "c_product_promotions": """SELECT l_orderkey * 10 + l_linenumber AS promotion_id, l_partkey AS product_id,
        l_suppkey AS seller_id, l_shipdate AS period_lo,
        l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS period_hi,
        CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_percentage FROM lineitem""",
    "c_outbox_events": """SELECT event_id, 'user' AS aggregate_type, user_id AS aggregate_id, event_type,
        props AS payload, ts AS created_at,
        CASE WHEN event_type <> 'error' THEN ts + INTERVAL 1 HOUR END AS processed_at, 0 AS retries
        FROM events""",
    # composite views
    "c_payment_summaries": """SELECT order_id, sum(payment_value) AS total_value,
        list_sort(list(DISTINCT payment_type)) AS payment_types,
        max(payment_installments) AS max_installments FROM c_order_payments GROUP BY order_id""",
    "c_orders_analytics": """SELECT o.order_id, o.order_status AS status, o.order_purchase_timestamp AS purchase_ts,
        strftime(o.order_purchase_timestamp, '%Y-%m') AS purchase_year_month, o.customer_id,
        c.customer_unique_id, c.customer_state AS state, c.customer_city AS city,
        c.customer_zip_code_prefix AS zip_code_prefix, coalesce(p.total_value, 0) AS total_value,
        coalesce(array_to_string(p.payment_types, ','), '') AS payment_types, p.max_installments
        FROM c_orders o LEFT JOIN c_customers c USING (customer_id)
        LEFT JOIN c_payment_summaries p USING (order_id)""",
    "c_products_catalog": """SELECT product_id, coalesce(product_category_name, 'unknown') AS name_pt,
        product_category_name_english AS name_en, CAST(product_name_lenght AS BIGINT) AS name_length,
        CAST(product_description_lenght AS BIGINT) AS description_length,
        CAST(product_photos_qty AS BIGINT) AS photos_qty, product_weight_g AS weight_g,
        product_length_cm AS length_cm, product_height_cm AS height_cm, product_width_cm AS width_cm,
        product_length_cm * product_height_cm * product_width_cm AS volume_cm3
        FROM c_products LEFT JOIN c_product_categories USING (product_category_name)""",
    "c_order_scores": """SELECT order_id, sum(review_score) AS score_sum, count(review_score) AS score_count
        FROM c_order_reviews GROUP BY order_id""",
    "c_product_ratings": """SELECT i.product_id, """ + half_even("sum(score_sum)", "nullif(sum(score_count), 0)", 1) + """ AS mean_score
        FROM (SELECT DISTINCT order_id, product_id FROM c_order_items) i JOIN c_order_scores s USING (order_id)
        GROUP BY 1""",
    "c_enriched_catalog": """SELECT p.product_id, coalesce(p.product_category_name, 'general') AS category,
        coalesce(""" + half_even("s.cents", "s.units * 100", 2) + """, 0) AS price,
        coalesce(s.units, 0) AS units, coalesce(r.mean_score, 0) AS rating,
        CAST(p.product_name_lenght AS BIGINT) AS name_length, CAST(p.product_photos_qty AS BIGINT) AS photos_qty,
        p.product_weight_g AS weight_g, p.product_width_cm AS width_cm
        FROM c_products p LEFT JOIN (SELECT product_id, CAST(sum(price) * 100 AS BIGINT) AS cents, count(*) AS units
        FROM c_order_items GROUP BY 1) s USING (product_id) LEFT JOIN c_product_ratings r USING (product_id)""",
    "c_revenue_groups": """SELECT o.state, CAST(date_trunc('month', o.purchase_ts) AS TIMESTAMP) AS month,
        CAST(count(*) AS BIGINT) AS total_orders, CAST(sum(o.total_value) AS DOUBLE) AS total_revenue,
        """ + half_even("sum(r.review_score)", "nullif(count(r.review_score), 0)", 2) + """
        AS avg_review_score FROM c_orders_analytics o LEFT JOIN c_order_reviews r USING (order_id)
        WHERE o.status = 'F' AND o.purchase_ts >= TIMESTAMP '1997-01-01'
        AND o.purchase_ts < TIMESTAMP '1998-01-01' GROUP BY 1, 2""",
}

_NEEDS = {
    "c_orders_delivered": ["c_orders"],
    "c_geo_locations": ["c_geolocations"],
    "c_payment_summaries": ["c_order_payments"],
    "c_orders_analytics": ["c_orders", "c_customers", "c_payment_summaries"],
    "c_products_catalog": ["c_products", "c_product_categories"],
    "c_order_scores": ["c_order_reviews"],
    "c_product_ratings": ["c_order_items", "c_order_scores"],
    "c_enriched_catalog": ["c_products", "c_order_items", "c_product_ratings"],
    "c_revenue_groups": ["c_orders_analytics", "c_order_reviews"],
}


def oracle(body: str) -> str:
    """Put the views a statement names, and those they need, in front of it."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in wanted:
            wanted.append(name)

    for name in sorted(CTES, key=len, reverse=True):
        if f"{name} " in body + " " or f"{name}\n" in body or f"{name})" in body or f"{name}," in body:
            add(name)
    if not wanted:
        return body
    views = ",\n".join(f"{name} AS ({CTES[name]})" for name in wanted)
    if body.lstrip().startswith("WITH "):
        return f"WITH {views},\n{body.lstrip()[5:]}"
    return f"WITH {views}\n{body}"
