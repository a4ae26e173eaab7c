"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.bindings import half_even
from checks.catalog import case, dbl
from storelens import schemas
from storelens.operators import joins, model_rules, quality
from storelens.plans import documents
from storelens.sinks import layout
from storelens.sources import scans
from storelens.session import fresh_path

_COLS = "\"check\", tbl, key, detail, rows"


def _violation(check: str, table: str, key: str, detail: str, body: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{table}' AS tbl, {key} AS key, {detail} AS detail, CAST(1 AS BIGINT) AS rows {body}"


@case(
    "v01_not_null",
    _violation("not_null:product_category_name", "products", "CAST(product_id AS VARCHAR)", "'product_category_name is null'",
               "FROM c_products WHERE product_category_name IS NULL")
    + " UNION ALL "
    + _violation("not_null:product_width_cm", "products", "CAST(product_id AS VARCHAR)", "'product_width_cm is null'",
                 "FROM c_products WHERE product_width_cm IS NULL"),
)
def _(t):
    rules = quality.not_null("product_id", "product_category_name", "product_width_cm")
    return quality.row_violations(t["products"], "products", ["product_id"], rules)


_MODEL_SQL = """WITH o AS (SELECT o_orderkey AS order_id, CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'lost' END AS order_status,
      o_orderdate AS bought, CASE WHEN o_orderkey % 50 = 0 THEN o_orderdate - INTERVAL 1 DAY END AS approved, o_custkey + CASE WHEN o_orderkey % 100 = 7 THEN 10000000 ELSE 0 END AS customer_id FROM orders),
    c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 40 = 0 THEN 'rj' ELSE 'RJ' END AS state, CASE WHEN c_custkey % 70 = 0 THEN NULL ELSE c_mktsegment END AS city FROM customer),
    i AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 7 THEN -l_extendedprice ELSE l_extendedprice END AS price FROM lineitem
      UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_orderkey % 64 = 1),
    p AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'boleto' WHEN 'A' THEN 'voucher' ELSE 'cash' END AS kind FROM lineitem),
    r AS (SELECT event_id, event_id * 3 // 4 AS order_id, CAST(floor(value) AS BIGINT) % 7 AS score FROM events),
    v AS (SELECT 'pattern:customer_state' AS "check", 'customers' AS tbl, 1 AS rows FROM c WHERE state = 'rj'
      UNION ALL SELECT 'not_null:customer_city', 'customers', 1 FROM c WHERE city IS NULL
      UNION ALL SELECT 'domain:order_status', 'orders', 1 FROM o WHERE order_status = 'lost'
      UNION ALL SELECT 'order:order_approved_at>=order_purchase_timestamp', 'orders', 1 FROM o WHERE approved < bought
      UNION ALL SELECT 'foreign:customer_id', 'orders', count(*) FROM o WHERE customer_id NOT IN (SELECT id FROM c) GROUP BY customer_id
      UNION ALL SELECT 'range:price', 'order_items', 1 FROM i WHERE price < 0
      UNION ALL SELECT 'unique:order_id,order_item_id', 'order_items', count(*) FROM i GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
      UNION ALL SELECT 'foreign:product_id', 'order_items', count(*) FROM i WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 90 <> 0) GROUP BY l_partkey
      UNION ALL SELECT 'unique:order_id,payment_sequential', 'order_payments', count(*) FROM p GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
      UNION ALL SELECT 'domain:payment_type', 'order_payments', 1 FROM p WHERE kind = 'cash'
      UNION ALL SELECT 'range:review_score', 'order_reviews', 1 FROM r WHERE score NOT BETWEEN 1 AND 5
      UNION ALL SELECT 'foreign:order_id', t, n FROM (SELECT 'order_reviews' AS t, count(*) AS n FROM r WHERE order_id NOT IN (SELECT order_id FROM o) GROUP BY order_id
        UNION ALL SELECT 'order_items', count(*) FROM i WHERE l_orderkey NOT IN (SELECT order_id FROM o) GROUP BY l_orderkey
        UNION ALL SELECT 'order_payments', count(*) FROM p WHERE l_orderkey NOT IN (SELECT order_id FROM o) GROUP BY l_orderkey))
    SELECT "check", tbl, CAST(count(*) AS BIGINT) AS keys, CAST(sum(rows) AS BIGINT) AS rows FROM v GROUP BY 1, 2"""


@case("v01_model_rules", _MODEL_SQL)
def _(t):
    """The model's rule sets over the whole table set, with violations put into the copies."""
    key, part, line = F.col("order_id"), F.col("p_partkey"), F.col("order_item_id")
    status = F.when(F.col("order_status") == "F", "delivered").when(F.col("order_status") == "O", "shipped").otherwise("lost")
    bought = F.col("order_purchase_timestamp")
    orders = t["orders"].withColumns(
        {
            "order_status": status,
            "order_approved_at": F.when(key % 50 == 0, bought - F.expr("INTERVAL 1 DAY")),
            "customer_id": F.col("customer_id") + F.when(key % 100 == 7, 10_000_000).otherwise(0),
        }
    )
    who = F.col("customer_id")
    customers = t["customers"].withColumns(
        {"customer_state": F.when(who % 40 == 0, "rj").otherwise("RJ"), "customer_city": F.when(who % 70 != 0, F.col("customer_city"))}
    )
    items = t["order_items"]
    items = items.withColumn("price", F.when(line == 7, -F.col("price")).otherwise(F.col("price"))).unionByName(items.filter(key % 64 == 1))
    kind = F.when(F.col("payment_type") == "R", "boleto").when(F.col("payment_type") == "A", "voucher").otherwise("cash")
    tables = {
        "orders": orders,
        "customers": customers,
        "order_items": items,
        "order_payments": t["order_payments"].withColumn("payment_type", kind),
        "order_reviews": t.star("events").select(
            F.col("event_id").alias("review_id"), F.expr("(event_id * 3) DIV 4").alias("order_id"), (F.floor("value") % 7).alias("review_score")
        ),
        "products": t["products"].filter(F.col("product_id") % 90 != 0),
    }
    return model_rules.summary(model_rules.check_tables(tables))


@case(
    "v02_unique_key",
    """SELECT 'unique:order_id,order_item_id' AS "check", 'order_items' AS tbl, order_id || '|' || order_item_id AS key,
    'repeated key' AS detail, count(*) AS rows FROM c_order_items GROUP BY order_id, order_item_id HAVING count(*) > 1""",
)
def _(t):
    return quality.unique_key(t["order_items"], "order_items", ["order_id", "order_item_id"])


@case(
    "v03_foreign_key",
    """SELECT 'foreign:customer_id' AS "check", 'parts' AS tbl, CAST(p_partkey AS VARCHAR) AS key, 'no such parent' AS detail,
    CAST(1 AS BIGINT) AS rows FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer) UNION ALL
    SELECT 'foreign:order_id', 'reviews', CAST(order_id AS VARCHAR), 'no such parent', count(*) FROM c_order_reviews
    WHERE order_id NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY order_id""",
)
def _(t):
    parts = t.star("part").select(F.col("p_partkey").alias("customer_id"))
    return quality.run_checks(
        [
            quality.foreign_key(parts, "parts", ["customer_id"], t.star("customer"), ["c_custkey"]),
            quality.foreign_key(
                t["order_reviews"], "reviews", ["order_id"], t.star("lineitem"), ["l_orderkey"]
            ),
        ]
    )


@case(
    "v03_foreign_key_two_columns",
    """SELECT 'foreign:order_id,customer_id' AS "check", 'orders' AS tbl, order_id || '|' || customer_id AS key,
    'no such parent' AS detail, CAST(1 AS BIGINT) AS rows FROM c_orders WHERE NOT EXISTS
    (SELECT 1 FROM events WHERE event_id = order_id AND user_id = customer_id)""",
)
def _(t):
    return quality.foreign_key(
        t["orders"], "orders", ["order_id", "customer_id"], t.star("events"), ["event_id", "user_id"]
    )


@case(
    "v04_numeric_range",
    _violation("range:review_score", "reviews", "CAST(review_id AS VARCHAR)", "'review_score=' || review_score",
               "FROM c_text_reviews WHERE review_score > 3")
    + " UNION ALL "
    + _violation("range:order_id", "reviews", "CAST(review_id AS VARCHAR)", "'order_id=' || order_id",
                 "FROM c_text_reviews WHERE NOT order_id > 0"),
)
def _(t):
    return quality.row_violations(
        t["text_reviews"],
        "reviews",
        ["review_id"],
        [quality.in_range("review_score", 1, 3), quality.in_range("order_id", 0, lo_open=True)],
    )


@case(
    "v05_domain",
    _violation("domain:order_status", "orders", "CAST(order_id AS VARCHAR)", "'order_status=' || order_status",
               "FROM c_orders WHERE order_status NOT IN ('F', 'O')"),
)
def _(t):
    return quality.row_violations(
        t["orders"], "orders", ["order_id"], [quality.in_domain("order_status", ["F", "O"])]
    )


@case(
    "v05_pattern",
    _violation("pattern:customer_state", "customers", "CAST(customer_id AS VARCHAR)", "'customer_state=' || customer_state",
               "FROM c_customers WHERE NOT regexp_matches(customer_state, '^NATION_[0-9]$')"),
)
def _(t):
    return quality.row_violations(
        t["customers"], "customers", ["customer_id"], [quality.matches("customer_state", "^NATION_[0-9]$")]
    )


@case(
    "v06_date_order",
    """SELECT 'order:order_approved_at>=order_purchase_timestamp' AS "check", 'orders' AS tbl, CAST(order_id AS VARCHAR) AS key,
    CAST(1 AS BIGINT) AS rows FROM c_orders_delivered WHERE order_approved_at < order_purchase_timestamp""",
)
def _(t):
    return quality.row_violations(
        t["orders_delivered"],
        "orders",
        ["order_id"],
        [quality.not_before("order_approved_at", "order_purchase_timestamp")],
    ).drop("detail")


@case(
    "v07_blank_text",
    """SELECT 'not_blank:text' AS "check", 'conversations' AS tbl, conv_id || '|' || turn AS key, 'text is blank' AS detail, CAST(1 AS BIGINT) AS rows
    FROM conversations WHERE length(trim(CASE WHEN (conv_id + turn) % 9 = 0 THEN '   ' ELSE text END, ' ')) = 0
    UNION ALL SELECT 'not_blank:review_comment_title', 'order_reviews', CAST(event_id AS VARCHAR), 'review_comment_title is blank', 1 FROM events WHERE event_type = 'click'""",
)
def _(t):
    """Blank texts, put into every ninth turn and in place of one kind of title."""
    turns = t.star("conversations")
    turns = turns.withColumn("text", F.when((F.col("conv_id") + F.col("turn")) % 9 == 0, "   ").otherwise(F.col("text")))
    reviews = t["order_reviews"].withColumn("review_comment_title", F.coalesce("review_comment_title", F.lit(" ")))
    return quality.row_violations(turns, "conversations", ["conv_id", "turn"], [quality.not_blank("text")]).unionByName(
        quality.row_violations(reviews, "order_reviews", ["review_id"], [quality.not_blank("review_comment_title")])
    )


@case(
    "v08_promotion_overlaps",
    """WITH p AS (SELECT product_id, period_lo, max(period_hi) AS hi, count(*) AS periods FROM c_product_promotions
    WHERE period_lo < period_hi GROUP BY 1, 2)
    SELECT product_id, period_lo, periods, open_until FROM (SELECT *, max(hi) OVER (PARTITION BY product_id ORDER BY period_lo
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_until FROM p)
    WHERE open_until > period_lo OR periods > 1""",
)
def _(t):
    return quality.overlapping_periods(
        t["product_promotions"], "product_id", "period_lo", "period_hi"
    )


@case(
    "v09_document_shape",
    """SELECT 'max:k' AS "check", 'props' AS tbl, CAST(event_id AS VARCHAR) AS key,
    'k=' || json_extract_string(props, '$.k') AS detail, CAST(1 AS BIGINT) AS rows FROM events
    WHERE CAST(json_extract(props, '$.k') AS INTEGER) > 49""",
)
def _(t):
    shape = {"required": ["k"], "fields": {"k": {"types": ["int"], "min": 0, "max": 49}}}
    rows = quality.dealt(t.star("events").select("event_id", "props"))
    docs = rows.select("event_id", F.try_parse_json("props").alias("doc"))
    return quality.validate_docs(docs, "doc", "event_id", shape, "props")


@case(
    "v09_catalog_documents",
    """SELECT 'type:product_id' AS "check", 'products_catalog' AS tbl, CAST(product_id AS VARCHAR) AS key,
    'product_id is BIGINT' AS detail, CAST(1 AS BIGINT) AS rows FROM c_products_catalog""",
)
def _(t):
    """Ids of the test tables are numbers where the shape wants text; all else must hold."""
    docs = quality.dealt(documents.products_catalog(t))
    text = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})
    parsed = docs.select("product_id", F.parse_json(text).alias("doc"))
    return quality.validate_docs(
        parsed, "doc", "product_id", schemas.PRODUCTS_CATALOG_DOC, "products_catalog"
    )


@case(
    "v09_geo_documents",
    """SELECT 'key' AS unused WHERE false""".replace("'key' AS unused", "'' AS \"check\", '' AS tbl, '' AS key, '' AS detail, CAST(0 AS BIGINT) AS rows"),
)
def _(t):
    docs = quality.dealt(documents.geolocation_points(t))
    parsed = docs.select(
        "zip_code_prefix", F.parse_json(F.to_json(F.struct(*docs.columns))).alias("doc")
    )
    return quality.validate_docs(
        parsed, "doc", "zip_code_prefix", schemas.GEOLOCATION_POINTS_DOC, "geolocation_points"
    )


def _shape_case(t, docs, key, shape, name):
    return quality.validate_docs(quality.dealt(docs.select(key, "document")).select(key, F.try_parse_json("document").alias("doc")), "doc", key, shape, name)


@case(
    "v09_review_documents",
    """SELECT 'type:review_id' AS "check", 'order_reviews' AS tbl, CAST(event_id AS VARCHAR) AS key, 'review_id is BIGINT' AS detail, CAST(1 AS BIGINT) AS rows FROM events
    UNION ALL SELECT 'type:order_id', 'order_reviews', CAST(event_id AS VARCHAR), 'order_id is BIGINT', 1 FROM events
    UNION ALL SELECT 'min:review_score', 'order_reviews', CAST(event_id AS VARCHAR), 'review_score=0', 1 FROM events WHERE CAST(floor(value) AS BIGINT) % 6 = 0
    UNION ALL SELECT 'required:review_score', 'order_reviews', CAST(event_id AS VARCHAR), 'review_score is missing', 1 FROM events WHERE CAST(floor(value) AS BIGINT) % 6 = 5
    UNION ALL SELECT 'type:review_creation_date', 'order_reviews', CAST(event_id AS VARCHAR), 'review_creation_date is STRING', 1 FROM events WHERE event_type = 'error'""",
)
def _(t):
    """Reviews as documents with numbers for ids, scores of 0, scores left out, and dates that are none."""
    score = F.floor("value") % 6
    docs = t.star("events").select(
        "event_id",
        F.to_json(
            F.struct(
                F.col("event_id").alias("review_id"),
                F.expr("(event_id * 3) DIV 4").alias("order_id"),
                F.when(score != 5, score).alias("review_score"),
                F.col("event_type").alias("review_comment_title"),
                F.when(F.col("event_type") == "error", "tomorrow").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("review_creation_date"),
            )
        ).alias("document"),
    )
    return _shape_case(t, docs, "event_id", schemas.ORDER_REVIEWS_DOC, "order_reviews")


@case(
    "v09_order_documents",
    """WITH d AS (SELECT o_orderkey AS id, CAST(o_orderkey AS VARCHAR) AS key, c_custkey AS known, o_orderstatus AS status FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
    SELECT "check", 'orders_analytics' AS tbl, key, detail, CAST(1 AS BIGINT) AS rows FROM (
    SELECT 'type:status' AS "check", key, 'status is BIGINT' AS detail FROM d WHERE status = 'P'
    UNION ALL SELECT 'required:purchase_ts', key, 'purchase_ts is missing' FROM d WHERE id % 30 = 0
    UNION ALL SELECT 'required:customer.city', key, 'customer.city is missing' FROM d WHERE id % 45 = 0 AND id % 77 <> 3
    UNION ALL SELECT 'type:payment_summary.payment_types', key, 'payment_summary.payment_types is STRING' FROM d WHERE id % 60 = 1
    UNION ALL SELECT 'required:customer', key, 'customer is missing' FROM d WHERE id % 77 = 3)""",
)
def _(t):
    """Order documents with a status that is a number, times, cities and customers left out, and types that are no list."""
    id_ = F.col("order_id")
    customer = F.struct(
        F.col("customer_id").cast("string").alias("customer_id"), F.lit("RJ").alias("state"), F.when(id_ % 45 != 0, "Rio").alias("city"), F.lit(20000).alias("zip_code_prefix")
    )
    body = F.struct(
        id_.cast("string").alias("order_id"),
        F.date_format("order_purchase_timestamp", "yyyy-MM").alias("purchase_year_month"),
        F.when(id_ % 30 != 0, F.date_format("order_purchase_timestamp", "yyyy-MM-dd'T'HH:mm:ss")).alias("purchase_ts"),
        F.when(id_ % 77 != 3, customer).alias("customer"),
    )
    status = F.when(F.col("order_status") == "P", "7").otherwise(F.concat(F.lit('"'), F.col("order_status"), F.lit('"')))
    types = F.when(id_ % 60 == 1, '"boleto"').otherwise('["boleto"]')
    more = F.concat(F.lit(',"status":'), status, F.lit(',"payment_summary":{"total_value":1.5,"max_installments":2,"payment_types":'), types, F.lit("}}"))
    docs = t["orders"].select("order_id", F.concat(F.regexp_replace(F.to_json(body), r"\}$", ""), more).alias("document"))
    return _shape_case(t, docs, "order_id", schemas.ORDERS_ANALYTICS_DOC, "orders_analytics")


@case(
    "v09_seller_bucket_documents",
    """WITH s AS (SELECT s_nationkey AS k, count(*) AS n, bool_or(s_suppkey % 9 = 0) AS numbers, bool_or(s_suppkey % 11 = 0) AS lost FROM supplier GROUP BY 1)
    SELECT "check", 'seller_state_buckets' AS tbl, CAST(k AS VARCHAR) AS key, detail, CAST(1 AS BIGINT) AS rows FROM (
    SELECT 'type:sellers' AS "check", k, 'sellers[] breaks type:sellers[].seller_id' AS detail FROM s WHERE numbers
    UNION ALL SELECT 'required:sellers', k, 'sellers[] breaks required:sellers[].city' FROM s WHERE lost
    UNION ALL SELECT 'type:seller_count', k, 'seller_count is STRING' FROM s WHERE k % 4 = 1)""".replace("'type:sellers' AS", "'type:sellers[].seller_id' AS").replace("'required:sellers', k", "'required:sellers[].city', k"),
)
def _(t):
    """Bucket documents in which some sellers have numbers for ids or no city, and some counts are text."""
    k = F.col("s_suppkey")
    seller = F.concat(
        F.lit('{"seller_id":'), F.when(k % 9 == 0, k.cast("string")).otherwise(F.concat(F.lit('"'), k, F.lit('"'))),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.lit(',"city":"Rio"')), F.lit("}"),
    )
    grouped = t.star("supplier").groupBy("s_nationkey").agg(F.concat_ws(",", F.collect_list(seller)).alias("all"), F.count("*").alias("n"))
    count = F.when(F.col("s_nationkey") % 4 == 1, F.concat(F.lit('"'), F.col("n"), F.lit('"'))).otherwise(F.col("n").cast("string"))
    docs = grouped.select(F.col("s_nationkey").alias("state"), F.concat(F.lit('{"state":"S","seller_count":'), count, F.lit(',"sellers":['), "all", F.lit("]}")).alias("document"))
    return _shape_case(t, docs, "state", schemas.SELLER_STATE_BUCKETS_DOC, "seller_state_buckets")


@case(
    "v10_duplicate_rows",
    """SELECT CAST((SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)) AS BIGINT) AS duplicate_rows""",
)
def _(t):
    return quality.duplicate_rows(t.star("documents").drop("doc_id"))


@case(
    "v11_atomicity",
    """SELECT 'doc_id' AS "column", 'bigint' AS type, false AS has_separator UNION ALL
    SELECT 'text', 'string', bool_or(regexp_matches(text, '[,;|]')) FROM documents UNION ALL
    SELECT 'lang', 'string', bool_or(regexp_matches(lang, '[,;|]')) FROM documents UNION ALL
    SELECT 'source', 'string', bool_or(regexp_matches(source, '[,;|]')) FROM documents UNION ALL
    SELECT 'n_chars', 'bigint', false""",
)
def _(t):
    return quality.atomicity(t.star("documents"))


_FULL = """(SELECT o.order_id FROM c_orders o LEFT JOIN c_order_items i USING (order_id)
    LEFT JOIN c_order_payments p USING (order_id) LEFT JOIN c_order_reviews r USING (order_id) )"""


def _denormalized(t):
    return joins.denormalize_orders(
        t["orders"].drop("metadata"), t["order_items"], t["order_payments"], t["order_reviews"]
    )


@case(
    "v12_granularity",
    f"""SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys
    FROM (SELECT order_id, count(*) AS n FROM {_FULL} GROUP BY 1)""",
)
def _(t):
    return quality.granularity(_denormalized(t), "order_id")


@case(
    "v12_repeated_keys",
    f"SELECT order_id, count(*) AS rows FROM {_FULL} GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
def _(t):
    return quality.repeated_keys(_denormalized(t), "order_id", 5)


@case(
    "v13_partial_dependency",
    """SELECT order_id, count(DISTINCT product_id) AS versions, CAST(count(*) AS BIGINT) AS rows FROM c_order_items
    JOIN c_orders USING (order_id) GROUP BY 1 HAVING count(DISTINCT product_id) > 1""",
)
def _(t):
    """The order does not determine the product, while it does determine status and customer."""
    rows = t["order_items"].join(t["orders"].drop("metadata"), "order_id")
    breaks = quality.determines(rows, ["order_id"], ["order_status", "customer_id"])
    products = quality.determines(rows, ["order_id"], ["product_id"])
    return products.unionByName(breaks)


@case(
    "v13_redundancy",
    """SELECT count(*) FILTER (n > 1) AS keys_repeated, CAST(sum(n - 1) AS BIGINT) AS rows_spare
    FROM (SELECT order_id, count(*) AS n FROM c_order_items GROUP BY 1)""",
)
def _(t):
    return quality.redundancy(t["order_items"], ["order_id"])


@case(
    "v14_transitive_dependency",
    """SELECT order_id, count(DISTINCT struct_pack(a := review_score, b := review_creation_date)) AS versions,
    CAST(count(*) AS BIGINT) AS rows FROM c_order_reviews GROUP BY 1
    HAVING count(DISTINCT struct_pack(a := review_score, b := review_creation_date)) > 1""",
)
def _(t):
    reviews = t["order_reviews"]
    right = ["review_score", "review_creation_date"]
    by_review = quality.determines(reviews, ["review_id"], right)
    by_order = quality.determines(reviews, ["order_id"], right)
    return by_order.unionByName(by_review.withColumnRenamed("review_id", "order_id"))


def _side(table: str, column: str) -> str:
    return f"(SELECT CASE WHEN max(n) = 1 THEN '1' ELSE 'N' END FROM (SELECT count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}))"


_RELATIONS = {
    "orders-items": ("c_orders", "c_order_items", "order_id"),
    "orders-payments": ("c_orders", "c_order_payments", "order_id"),
    "orders-reviews": ("c_orders", "c_order_reviews", "order_id"),
    "customers-orders": ("c_customers", "c_orders", "customer_id"),
    "products-items": ("c_products", "c_order_items", "product_id"),
    "sellers-items": ("c_sellers", "c_order_items", "seller_id"),
    "translations-products": ("c_product_categories", "c_products", "product_category_name"),
    "documents-labels": ("documents", "labels", "doc_id"),
}


@case(
    "v15_cardinality",
    " UNION ALL ".join(f"SELECT '{name}' AS relation, {_side(a, key)} AS left_side, {_side(b, key)} AS right_side" for name, (a, b, key) in _RELATIONS.items()),
)
def _(t):
    out = None
    for name, (a, b, key) in _RELATIONS.items():
        # the translations come with a row per product here
        tables = [t[x[2:]].distinct() if x == "c_product_categories" else t[x[2:]] if x.startswith("c_") else t.star(x) for x in (a, b)]
        row = quality.cardinality(*tables, key).select(F.lit(name).alias("relation"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@case(
    "v16_rows_per_partition",
    """SELECT CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
    THEN strftime(o_orderdate, '%Y') ELSE 'default' END AS part, count(*) AS rows FROM orders GROUP BY 1""",
)
def _(t):
    path = fresh_path(t.spark, "v16")
    layout.write_partitioned(
        t["orders"], path, "order_purchase_timestamp", "year", "1996-01-01", "2000-01-01"
    )
    return quality.rows_per_partition(scans.read_partitioned(t.spark, path))


@case(
    "v16_default_rows",
    """SELECT count(*) AS rows_in_default FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '1996-01-01'
    AND o_orderdate < TIMESTAMP '2000-01-01')""",
)
def _(t):
    bucket = layout.range_bucket(
        F.col("order_purchase_timestamp"), "year", "1996-01-01", "2000-01-01"
    )
    return quality.default_rows(t["orders"].withColumn("part", bucket))


@case(
    "v16_files_per_partition",
    """SELECT CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
    THEN strftime(o_orderdate, '%Y') ELSE 'default' END AS part, count(*) AS rows, true AS has_files, true AS has_bytes FROM orders GROUP BY 1""",
)
def _(t):
    """Rows by the file-backed report; how many files and bytes is the writer's choice."""
    path = fresh_path(t.spark, "v16f")
    layout.write_partitioned(t["orders"], path, "order_purchase_timestamp", "year", "1996-01-01", "2000-01-01")
    found = quality.bytes_per_partition(t.spark.read.parquet(path))
    return found.select(F.col("part").cast("string").alias("part"), "rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > F.col("files")).alias("has_bytes"))


@case("v16_bytes_per_partition")
def _(t):
    path = fresh_path(t.spark, "v16b")
    layout.write_partitioned(
        t["orders"], path, "order_purchase_timestamp", "year", "1996-01-01", "2000-01-01"
    )
    return quality.bytes_per_partition(t.spark.read.parquet(path))


@case(
    "v17_table_counts",
    " UNION ALL ".join(
        f"SELECT '{n}' AS tbl, count(*) AS rows FROM {n}" for n in ("orders", "lineitem", "events", "documents")
    ),
)
def _(t):
    return quality.table_counts(
        {n: t.star(n) for n in ("orders", "lineitem", "events", "documents")}
    )


@case(
    "v18_bucket_balance",
    """WITH b AS (SELECT CAST(list_sum(list_transform(string_split(sha256(CAST(o_orderkey AS VARCHAR)), ''),
    lambda d: strpos('0123456789abcdef', d) - 1)) % 3 AS BIGINT) AS shard FROM orders)
    SELECT shard, count(*) AS orders, """
    + half_even("count(*) * 100", "(SELECT count(*) FROM orders)", 2)
    + """ AS percentage FROM b GROUP BY 1""",
)
def _(t):
    return quality.bucket_balance(t["orders"], "order_id", 3)


@case(
    "v19_integrity_error_rate",
    """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (l_orderkey IS NULL) AS BIGINT) AS orphan_rows,
    round(CAST(count(*) FILTER (l_orderkey IS NULL) AS DOUBLE) / count(*), 6) AS error_rate
    FROM c_order_reviews LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = order_id""",
)
def _(t):
    out = quality.integrity_error_rate(
        t["order_reviews"], "order_id", t.star("lineitem"), "l_orderkey"
    )
    return out.select("rows", "orphan_rows", dbl("error_rate"))
