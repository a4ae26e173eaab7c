"""Filters, projections, scalar functions, text search and distance."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.bindings import half_even
from checks.catalog import case
from checks.reporting import _SPHERE, _grams, _similar
from storelens.functions import geo, predicates, scalars, text
from storelens.operators import paging, reshape, search
from storelens.plans import documents, reports
from storelens.session import fresh_path
from storelens.sources import json_paths

# -- predicates ------------------------------------------------------------------------


@case("p01_equality", "SELECT order_id, customer_id FROM c_orders WHERE order_status = 'P'")
def _(t):
    return t["orders"].filter(F.col("order_status") == "P").select("order_id", "customer_id")


@case(
    "p02_half_open_range",
    """SELECT order_id FROM c_orders WHERE order_purchase_timestamp >= TIMESTAMP '1996-02-01'
    AND order_purchase_timestamp < TIMESTAMP '1996-03-01'""",
)
def _(t):
    ts = F.col("order_purchase_timestamp")
    return t["orders"].filter(predicates.month_range(ts, "1996-02")).select("order_id")


@case(
    "p03_truncated_day",
    "SELECT order_id FROM c_orders WHERE date_trunc('day', order_purchase_timestamp) = TIMESTAMP '1996-02-29'",
)
def _(t):
    ts = F.col("order_purchase_timestamp")
    return t["orders"].filter(predicates.truncated_day_is(ts, "1996-02-29")).select("order_id")


@case(
    "p04_compare_columns",
    """SELECT order_id FROM c_orders_delivered
    WHERE order_delivered_customer_date > order_estimated_delivery_date""",
)
def _(t):
    late = predicates.is_late(
        F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    )
    return t["orders_delivered"].filter(late).select("order_id")


@case(
    "p05_numeric_tests",
    """SELECT review_id FROM c_order_reviews JOIN events ON event_id = review_id
    WHERE value > 0 AND value < 50 AND review_score <= 3""",
)
def _(t):
    rows = t["order_reviews"].join(
        t.star("events").select(F.col("event_id").alias("review_id"), "value"), "review_id"
    )
    return rows.filter(
        (F.col("value") > 0) & (F.col("value") < 50) & (F.col("review_score") <= 3)
    ).select("review_id")


@case(
    "p06_null_tests",
    """SELECT review_id, review_comment_title IS NULL AS no_title FROM c_order_reviews
    WHERE review_comment_message IS NOT NULL AND review_answer_timestamp IS NULL""",
)
def _(t):
    return (
        t["order_reviews"]
        .filter(
            predicates.has_text(F.col("review_comment_message"))
            & F.col("review_answer_timestamp").isNull()
        )
        .select("review_id", F.col("review_comment_title").isNull().alias("no_title"))
    )


@case(
    "p07_membership",
    "SELECT product_id FROM c_products WHERE product_category_name IN ('ECONOMY', 'SMALL')",
)
def _(t):
    return t["products"].filter(F.col("product_category_name").isin("ECONOMY", "SMALL")).select(
        "product_id"
    )


@case(
    "p08_folded_contains",
    "SELECT doc_id FROM documents WHERE strip_accents(lower(text)) LIKE '%ecion%'",
)
def _(t):
    docs = t.star("documents")
    return docs.filter(predicates.folded_contains(F.col("text"), "ÉCIÓN")).select("doc_id")


@case(
    "p08_folded_like",
    "SELECT c_custkey FROM customer WHERE strip_accents(c_mktsegment) ILIKE '%h_n%y'",
)
def _(t):
    rows = t.star("customer")
    return rows.filter(predicates.folded_like(F.col("c_mktsegment"), "%h_ñ%y")).select("c_custkey")


@case(
    "p09_json_contains",
    "SELECT event_id FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) = 42",
)
def _(t):
    rows = t.star("events")
    return rows.filter(predicates.json_contains(F.col("props"), {"k": 42})).select("event_id")


@case(
    "p09_json_paths",
    """SELECT event_id FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) BETWEEN 40 AND 42
    UNION ALL SELECT -p_partkey FROM part WHERE p_size > 25 AND p_size % 10 = 0 AND p_size % 25 = 5""",
)
def _(t):
    """Containment over tables whose declared paths are columns; one path of the second is left to the text."""
    events, products = json_paths.JsonPaths("props", {"k": "double"}), json_paths.JsonPaths(
        "product_specifications", {"logistics.weight_class": "string", "warranty_months": "double"}
    )
    paths = [fresh_path(t.spark, "p09") for _ in range(2)]
    json_paths.with_paths(t.star("events").select("event_id", "props"), events).write.parquet(paths[0])
    json_paths.with_paths(t["products"].select("product_id", "product_specifications"), products).write.parquet(paths[1])
    held = t.spark.read.parquet(paths[0])
    ks = held.filter(json_paths.holds(events, {"k": 40}) | json_paths.holds(events, {"k": 41.0}) | json_paths.holds(events, {"k": 42}))
    heavy = {"logistics": {"weight_class": "heavy", "fragile": True}, "warranty_months": 5}
    found = t.spark.read.parquet(paths[1]).filter(json_paths.holds(products, heavy))
    return ks.select("event_id").union(found.select(-F.col("product_id")))


@case(
    "p10_array_contains",
    "SELECT product_id FROM c_products WHERE list_has_all(search_tokens, ['ring', 'small'])",
)
def _(t):
    return (
        t["products"]
        .filter(predicates.array_has_all(F.col("search_tokens"), ["small", "ring"]))
        .select("product_id")
    )


@case(
    "p11_period_contains",
    """SELECT promotion_id, seller_id FROM c_product_promotions
    WHERE period_lo <= TIMESTAMP '1999-01-01' AND period_hi > TIMESTAMP '1999-01-01'""",
)
def _(t):
    live = predicates.active_at(F.col("period_lo"), F.col("period_hi"), "1999-01-01")
    return t["product_promotions"].filter(live).select("promotion_id", "seller_id")


@case(
    "p12_similar_text",
    f"""SELECT url, round({_similar('g', 'q')}, 6) AS score FROM (SELECT url, {_grams('url')} AS g,
    {_grams("'https://site3.example.com/page/12'")} AS q FROM pages) WHERE {_similar('g', 'q')} >= 0.3""",
)
def _(t):
    found = text.fuzzy_search(
        t.star("pages").select("url"), "url", "https://site3.example.com/page/12"
    )
    return found.withColumn("score", F.round("score", 6))


@case(
    "p13_after_cursor",
    "SELECT p_partkey, p_name FROM part WHERE p_partkey > 77",
)
def _(t):
    parts = t.star("part").select("p_partkey", "p_name")
    return parts.filter(predicates.after_cursor(F.col("p_partkey"), 77))


@case(
    "p14_pattern",
    "SELECT doc_id, regexp_matches(text, '[,;|]') AS has_separator FROM documents",
)
def _(t):
    docs = t.star("documents")
    return docs.select("doc_id", predicates.has_separator(F.col("text")).alias("has_separator"))


@case("p15_between", "SELECT p_partkey FROM part WHERE p_size BETWEEN 10 AND 20")
def _(t):
    return t.star("part").filter(F.col("p_size").between(10, 20)).select("p_partkey")


# -- projections and reshaping ---------------------------------------------------------


@case("r01_project_rename", "SELECT order_id AS id, order_status AS status FROM c_orders")
def _(t):
    return t["orders"].withColumnsRenamed({"order_id": "id", "order_status": "status"}).select(
        "id", "status"
    )


@case(
    "r02_computed_fields",
    """SELECT review_id, CAST(date_trunc('month', review_creation_date) AS TIMESTAMP) AS review_month,
    CAST(length(review_comment_message) AS INTEGER) AS comment_length FROM c_order_reviews""",
)
def _(t):
    reviews = t["order_reviews"]
    return reviews.withColumns(
        {
            "review_month": scalars.month_start(reviews, "review_creation_date"),
            "comment_length": F.char_length("review_comment_message"),
        }
    ).select("review_id", "review_month", "comment_length")


@case("r03_nested_path", "SELECT order_id, state, CAST(total_value AS DOUBLE) AS total_value FROM c_orders_analytics")
def _(t):
    docs = documents.orders_analytics(t)
    return docs.select(
        "order_id",
        F.col("customer.state").alias("state"),
        F.col("payment_summary.total_value").cast("double").alias("total_value"),
    )


@case("r04_unwind", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token FROM part")
def _(t):
    rows = t["products"].select(F.col("product_id").alias("p_partkey"), "search_tokens")
    return reshape.unwind(rows, "search_tokens", "token")


@case(
    "r05_unwind_keep_empty",
    """SELECT order_id, payment_type FROM (SELECT order_id, CASE WHEN payment_types = '' THEN NULL
    ELSE unnest(CASE WHEN payment_types = '' THEN [NULL] ELSE string_split(payment_types, ',') END) END
    AS payment_type FROM c_orders_analytics)""",
)
def _(t):
    docs = documents.orders_analytics(t).select(
        "order_id", F.col("payment_summary.payment_types").alias("types")
    )
    return reshape.unwind(docs, "types", "payment_type", keep_empty=True)


@case(
    "r06_attribute_pairs",
    """SELECT product_id, unnest(['weight_g', 'length_cm', 'height_cm', 'width_cm', 'volume_cm3']) AS k,
    unnest([weight_g, length_cm, height_cm, width_cm, volume_cm3]) AS v FROM c_products_catalog""",
)
def _(t):
    docs = documents.products_catalog(t)
    return reshape.unwind(docs.select("product_id", "attributes"), "attributes", "a").select(
        "product_id", "a.k", "a.v"
    )


@case(
    "r07_present_keys",
    """SELECT product_id, CASE WHEN photos_qty IS NULL THEN 2 ELSE 3 END AS entries,
    CAST(photos_qty AS VARCHAR) AS photos FROM c_enriched_catalog""",
)
def _(t):
    docs = documents.enriched_catalog(t)
    return docs.select(
        "product_id",
        F.size("specifications").alias("entries"),
        F.try_element_at("specifications", F.lit("photos_qty")).alias("photos"),
    )


@case(
    "r08_omit_null_fields",
    """SELECT review_id, 5 + CASE WHEN review_comment_title IS NULL THEN 0 ELSE 1 END
    + CASE WHEN review_comment_message IS NULL THEN 0 ELSE 1 END
    + CASE WHEN review_answer_timestamp IS NULL THEN 0 ELSE 1 END - 1 AS fields FROM c_order_reviews""",
)
def _(t):
    docs = documents.review_documents(t)
    return docs.select("review_id", F.size(F.json_object_keys("document")).alias("fields"))


@case("r09_pair_lookup", "SELECT product_id, weight_g, volume_cm3 FROM c_products_catalog")
def _(t):
    docs = documents.products_catalog(t)
    return docs.select(
        "product_id",
        reshape.pair_value("attributes", "weight_g").alias("weight_g"),
        reshape.pair_value("attributes", "volume_cm3").alias("volume_cm3"),
    )


# -- scalar functions ------------------------------------------------------------------


@case(
    "f01_truncate",
    """SELECT event_id, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month,
    CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events""",
)
def _(t):
    events = t.star("events")
    return events.select(
        "event_id",
        scalars.month_start(events, "ts").alias("month"),
        scalars.day_start(events, "ts").alias("day"),
    )


@case(
    "f02_year_month",
    """SELECT review_id, coalesce(strftime(review_answer_timestamp, '%Y-%m'), 'unknown') AS answered,
    strftime(review_creation_date, '%Y_%m') AS part FROM c_order_reviews""",
)
def _(t):
    return t["order_reviews"].select(
        "review_id",
        scalars.year_month(F.col("review_answer_timestamp")).alias("answered"),
        F.date_format("review_creation_date", "yyyy_MM").alias("part"),
    )


@case(
    "f03_lenient_timestamp",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS parsed FROM events""",
)
def _(t):
    raw = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return t.star("events").select(
        "event_id", scalars.lenient_timestamp(raw).cast("timestamp_ntz").alias("parsed")
    )


@case(
    "f04_month_arithmetic",
    "SELECT order_id, order_purchase_timestamp + INTERVAL 1 MONTH AS next_month FROM c_orders",
)
def _(t):
    return t["orders"].select(
        "order_id", scalars.months_after(F.col("order_purchase_timestamp"), 1).alias("next_month")
    )


@case(
    "f05_coalesce",
    "SELECT product_id, coalesce(product_width_cm, 0) AS width, coalesce(product_category_name, 'general') AS category FROM c_products",
)
def _(t):
    return t["products"].select(
        "product_id",
        scalars.or_zero(F.col("product_width_cm")).alias("width"),
        F.coalesce("product_category_name", F.lit("general")).alias("category"),
    )


@case(
    "f06_half_even",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round_even(CAST(l_extendedprice AS DECIMAL(12,2)), 1) AS DOUBLE) AS price FROM lineitem",
)
def _(t):
    return t.star("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        scalars.half_even(F.col("l_extendedprice").cast("decimal(12,2)"), 1)
        .cast("double")
        .alias("price"),
    )


@case(
    "f07_arithmetic",
    """SELECT product_id, product_length_cm * product_height_cm * product_width_cm AS volume_strict,
    coalesce(product_length_cm, 0) * coalesce(product_height_cm, 0) * coalesce(product_width_cm, 0) AS volume,
    product_weight_g / 1000 AS kg FROM c_products""",
)
def _(t):
    sides = [F.col(c) for c in ("product_length_cm", "product_height_cm", "product_width_cm")]
    return t["products"].select(
        "product_id",
        scalars.volume_or_null(*sides).alias("volume_strict"),
        scalars.volume_or_zero(*sides).alias("volume"),
        scalars.kilometres(F.col("product_weight_g")).alias("kg"),
    )


@case(
    "f08_text_length",
    "SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, CAST(length(trim(source)) AS INTEGER) AS trimmed FROM documents",
)
def _(t):
    return t.star("documents").select(
        "doc_id",
        F.char_length("text").alias("chars"),
        scalars.trimmed_length(F.col("source")).alias("trimmed"),
    )


@case(
    "f09_display_name",
    """SELECT p_partkey, 'Producto ' || array_to_string(list_transform(string_split(lower(p_name || '_' || p_brand), ' '),
    lambda w: array_to_string(list_transform(string_split(replace(replace(w, '_', ' '), '#', '# '), ' '),
    lambda v: upper(substring(v, 1, 1)) || substring(v, 2)), ' ')), ' ') || ' - ' || substring(CAST(p_partkey AS VARCHAR), 1, 5)
    AS name FROM part""".replace("'# '", "'# '"),
)
def _(t):
    label = F.concat(F.col("p_name"), F.lit("_"), F.regexp_replace("p_brand", "#", "# "))
    return t.star("part").select(
        "p_partkey", scalars.product_name(label, F.col("p_partkey")).alias("name")
    )


@case(
    "f10_photo_urls",
    "SELECT p_partkey, 'https://images.example/' || p_partkey || '_1.jpg' AS photo FROM part",
)
def _(t):
    return t.star("part").select(
        "p_partkey", scalars.photo_urls(F.col("p_partkey"))[0].alias("photo")
    )


@case(
    "f11_narrow",
    """SELECT p_partkey, CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
    ELSE CAST(p_retailprice AS VARCHAR) END AS price,
    CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(p_retailprice AS BIGINT) END AS whole FROM part""",
)
def _(t):
    return t.star("part").select(
        "p_partkey",
        scalars.narrow(F.col("p_retailprice")).cast("string").alias("price"),
        scalars.whole_or_null(F.col("p_retailprice")).alias("whole"),
    )


@case(
    "f12_json_object",
    """SELECT product_id, CAST(json_extract('{"w":' || product_weight_g || '}', '$.w') AS DOUBLE) AS weight_g,
    coalesce(product_length_cm, 0) * coalesce(product_height_cm, 0) * coalesce(product_width_cm, 0) AS volume_cm3,
    product_width_cm IS NULL AS width_is_null FROM c_products""",
)
def _(t):
    doc = scalars.dimensions_json(
        F.col("product_weight_g"),
        F.col("product_length_cm"),
        F.col("product_height_cm"),
        F.col("product_width_cm"),
    )
    parsed = t["products"].select("product_id", F.parse_json(doc).alias("d"))
    return parsed.select(
        "product_id",
        F.variant_get("d", "$.weight_g", "double").alias("weight_g"),
        F.variant_get("d", "$.volume_cm3", "double").alias("volume_cm3"),
        F.is_variant_null(F.variant_get("d", "$.width_cm", "variant")).alias("width_is_null"),
    )


@case(
    "f13_weight_class",
    """SELECT product_id, CASE WHEN coalesce(product_weight_g, 0) > 1000 THEN 'heavy'
    WHEN coalesce(product_weight_g, 0) > 300 THEN 'medium' ELSE 'light' END AS weight_class FROM c_products""",
)
def _(t):
    return t["products"].select(
        "product_id", scalars.weight_class(F.col("product_weight_g")).alias("weight_class")
    )


# The digest modulo 3 equals the sum of its hex digits modulo 3 (16 = 1 mod 3);
# modulo 16 it is the last digit.
@case(
    "f14_hash_bucket",
    """SELECT o_orderkey, CAST(list_sum(list_transform(string_split(sha256(CAST(o_orderkey AS VARCHAR)), ''),
    lambda d: strpos('0123456789abcdef', d) - 1)) % 3 AS INTEGER) AS third,
    CAST(strpos('0123456789abcdef', right(sha256(CAST(o_orderkey AS VARCHAR)), 1)) - 1 AS INTEGER) AS sixteenth
    FROM orders""",
)
def _(t):
    return t.star("orders").select(
        "o_orderkey",
        scalars.hash_bucket(F.col("o_orderkey"), 3).cast("int").alias("third"),
        scalars.hash_bucket(F.col("o_orderkey"), 16).cast("int").alias("sixteenth"),
    )


@case(
    "f15_improvement",
    "SELECT l_partkey, CASE WHEN b IS NULL OR a IS NULL OR b = 0 THEN NULL ELSE "
    + half_even("(b - a) * 100", "b", 2)
    + """ END AS improvement
    FROM (SELECT l_partkey, sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) END) AS b,
    sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS INTEGER) END) AS a FROM lineitem GROUP BY 1)""",
)
def _(t):
    units = F.col("l_quantity").cast("int")
    sums = (
        t.star("lineitem")
        .groupBy("l_partkey")
        .agg(
            F.sum(F.when(F.col("l_returnflag") == "R", units)).alias("b"),
            F.sum(F.when(F.col("l_returnflag") == "A", units)).alias("a"),
        )
    )
    return sums.select(
        "l_partkey", scalars.improvement_percent(F.col("b"), F.col("a")).alias("improvement")
    )


@case(
    "f16_read_efficiency",
    """SELECT user_id, round(CAST(count(*) AS DOUBLE) / greatest(count(*) FILTER (event_type = 'purchase'), 1), 6) AS efficiency
    FROM events GROUP BY 1""",
)
def _(t):
    counted = (
        t.star("events")
        .groupBy("user_id")
        .agg(
            F.count("*").alias("examined"),
            F.count_if(F.col("event_type") == "purchase").alias("returned"),
        )
    )
    return counted.select(
        "user_id",
        F.round(scalars.read_efficiency(F.col("examined"), F.col("returned")), 6).alias("efficiency"),
    )


@case(
    "f17_grouped_digits",
    "SELECT o_orderkey, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS whole FROM orders",
)
def _(t):
    return t.star("orders").select(
        "o_orderkey", scalars.grouped_digits(F.floor("o_totalprice")).alias("whole")
    )


@case(
    "f18_separator_flags",
    """SELECT conv_id, turn, regexp_matches(text, '[,;|]') AS has_separator FROM conversations""",
)
def _(t):
    return t.star("conversations").select(
        "conv_id", "turn", predicates.has_separator(F.col("text")).alias("has_separator")
    )


@case(
    "f19_event_keys",
    """SELECT event_id, sha256(length(CAST(user_id AS VARCHAR)) || '|' || length(event_type) || '|' || user_id || '|' || event_type) AS key
    FROM events""",
)
def _(t):
    return t.star("events").select(
        "event_id", scalars.event_key(F.col("user_id"), F.col("event_type")).alias("key")
    )


# -- text search -----------------------------------------------------------------------


@case(
    "x01_folded_counts",
    """SELECT lang, source, count(*) AS docs FROM documents WHERE strip_accents(lower(text)) LIKE '%tion%'
    GROUP BY 1, 2""",
)
def _(t):
    return reports.folded_text_counts(
        t.star("documents"), "text", "tión", ["lang", "source"], "docs"
    )


@case(
    "x02_similarity",
    f"""SELECT doc_id, round({_similar('a', 'b')}, 6) AS score FROM (SELECT doc_id, {_grams('text')} AS a,
    {_grams("lang || ' ' || source || ' the der la'")} AS b FROM documents)""",
)
def _(t):
    hint = F.concat_ws(" ", "lang", "source", F.lit("the der la"))
    return t.star("documents").select(
        "doc_id", F.round(text.similarity(F.col("text"), hint), 6).alias("score")
    )


_FUZZY_SQL = f"""SELECT a.v AS left_value, b.v AS right_value, round({_similar('a.g', 'b.g')}, 6) AS score
    FROM (SELECT v, {_grams('v')} AS g FROM (SELECT DISTINCT url AS v FROM pages)) a
    JOIN (SELECT v, {_grams('v')} AS g FROM (SELECT DISTINCT p_name || ' ' || p_type || ' page' AS v FROM part
    UNION SELECT DISTINCT url AS v FROM pages)) b
    ON {_similar('a.g', 'b.g')} >= """


def _fuzzy(t, threshold):
    names = t.star("part").select(F.concat_ws(" ", "p_name", "p_type", F.lit("page")).alias("v"))
    urls = t.star("pages").select(F.col("url").alias("v"))
    found = text.fuzzy_join(urls, names.union(urls), "v", "v", threshold)
    return found.withColumn("score", F.round("score", 6))


@case("x03_fuzzy_join", _FUZZY_SQL + "0.7")
def _(t):
    return _fuzzy(t, 0.7)


@case("x03_fuzzy_join_loose", _FUZZY_SQL + "0.3")
def _(t):
    return _fuzzy(t, 0.3)


_KEYWORD_SQL = """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(source || ' ' || text), '[^\\p{L}\\p{N}]+'),
    lambda x: x <> '') AS ws FROM documents),
    c AS (SELECT doc_id, len(list_filter(ws, lambda x: x = 'hat')) AS a, len(list_filter(ws, lambda x: x = 'und')) AS b,
    len(list_filter(ws, lambda x: x = 'src3')) AS d FROM w),
    n AS (SELECT count(*) AS n, count(*) FILTER (a > 0) AS na, count(*) FILTER (b > 0) AS nb,
    count(*) FILTER (d > 0) AS nd FROM c)
    SELECT doc_id, round(a * (ln((n + 1) / (na + 1)) + 1) + b * (ln((n + 1) / (nb + 1)) + 1)
    + d * (ln((n + 1) / (nd + 1)) + 1), 6) AS score FROM c, n WHERE a > 0 OR b > 0 OR d > 0"""


@case("x04_keyword_search", _KEYWORD_SQL)
def _(t):
    docs = t.star("documents").select("doc_id", "text", "source")
    found = text.keyword_search(docs, ["source", "text"], "hat und SRC3 para")
    return found.select("doc_id", F.round("score", 6).alias("score"))


# -- distance --------------------------------------------------------------------------


@case("x04_keyword_index", _KEYWORD_SQL)
def _(t):
    """The same scores from a written index, of which the query's words alone are read."""
    path = fresh_path(t.spark, "x04-index")
    search.build_index(t.star("documents").select("doc_id", "text", "source"), "doc_id", ["source", "text"], path)
    found = search.search(t.spark, path, "hat und SRC3 para")
    return found.select(F.col("key").alias("doc_id"), F.round("score", 6).alias("score"))


@case(
    "g01_points",
    """SELECT geolocation_zip_code_prefix AS zip, geolocation_lng AS lng, geolocation_lat AS lat,
    geolocation_lng BETWEEN -180 AND 180 AND geolocation_lat BETWEEN -90 AND 90 AS valid FROM c_geolocations""",
)
def _(t):
    lng, lat = F.col("geolocation_lng"), F.col("geolocation_lat")
    points = t["geolocations"].select(
        F.col("geolocation_zip_code_prefix").alias("zip"),
        geo.point(lng, lat).alias("p"),
        geo.valid_coordinates(lng, lat).alias("valid"),
    )
    return points.select("zip", "p.lng", "p.lat", "valid")


@case(
    "g02_sphere_distance",
    "SELECT geolocation_zip_code_prefix AS zip, geolocation_lat AS lat, round("
    + _SPHERE.format(lat1="geolocation_lat", lng1="geolocation_lng", lat2="-23.5505::DOUBLE", lng2="-46.6333::DOUBLE")
    + ", 2) AS metres FROM c_geolocations",
)
def _(t):
    metres = geo.sphere_m(
        F.col("geolocation_lat"), F.col("geolocation_lng"), F.lit(-23.5505), F.lit(-46.6333)
    )
    return t["geolocations"].select(
        F.col("geolocation_zip_code_prefix").alias("zip"),
        F.col("geolocation_lat").alias("lat"),
        F.round(metres, 2).alias("metres"),
    )


@case(
    "d05_geolocation_points",
    """SELECT zip_code_prefix, city, state, 'Point' AS type, longitude AS lng, latitude AS lat FROM c_geo_locations""",
)
def _(t):
    docs = documents.geolocation_points(t)
    return docs.select(
        "zip_code_prefix",
        "city",
        "state",
        "location.type",
        F.col("location.coordinates")[0].alias("lng"),
        F.col("location.coordinates")[1].alias("lat"),
    )


@case(
    "g03_nearest_each",
    "WITH q AS (SELECT DISTINCT geolocation_lat AS qlat, geolocation_lng AS qlng FROM c_geolocations WHERE geolocation_zip_code_prefix % 10 = 0),"
    " d AS (SELECT qlat, qlng, geolocation_zip_code_prefix AS zip, geolocation_city AS city, geolocation_state AS state, "
    + _SPHERE.format(lat1="geolocation_lat", lng1="geolocation_lng", lat2="qlat", lng2="qlng")
    + " AS m FROM c_geolocations, q) SELECT qlat, qlng, zip, city, state, round(m, 2) AS metres, row_number() OVER"
    " (PARTITION BY qlat, qlng ORDER BY round(m, 3), zip, city, state) AS place FROM d QUALIFY place <= 3",
)
def _(t):
    """Three nearest points of each of a tenth of the places, down a quadtree."""
    points = t["geolocations"]
    places = points.filter(F.col("geolocation_zip_code_prefix") % 10 == 0).select(
        F.col("geolocation_lat").cast("double").alias("qlat"), F.col("geolocation_lng").cast("double").alias("qlng")
    )
    queries = places.distinct().withColumn("query", F.concat_ws(" ", "qlat", "qlng"))
    found = geo.nearest_each(
        points, queries, "geolocation_lat", "geolocation_lng", "qlat", "qlng", "query", 3,
        ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"],
    )
    metres = geo.sphere_m(F.col("geolocation_lat"), F.col("geolocation_lng"), F.col("qlat"), F.col("qlng"))
    return found.select(
        "qlat",
        "qlng",
        F.col("geolocation_zip_code_prefix").alias("zip"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
        F.round(metres, 2).alias("metres"),
        F.col("place").cast("bigint").alias("place"),
    )


@case(
    "g03_nearest_dense",
    """WITH p AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN -34 + (c_custkey % 390) / 10.0::DOUBLE
      ELSE -23.55 + (c_custkey % 997) / 1000000.0::DOUBLE END AS lat,
      CASE WHEN c_custkey % 5 = 0 THEN -74 + (c_custkey % 400) / 10.0::DOUBLE ELSE -46.63 + (c_custkey % 991) / 1000000.0::DOUBLE END AS lng FROM customer),
    q AS (SELECT s_suppkey AS query, -23.55 + (s_suppkey % 1009) / 1000000.0::DOUBLE AS qlat, -46.63 + (s_suppkey % 1013) / 1000000.0::DOUBLE AS qlng FROM supplier)
    SELECT query, id, row_number() OVER (PARTITION BY query ORDER BY round(m, 3), id) AS place, round(m, 2) AS metres FROM (SELECT query, id, """
    + _SPHERE.format(lat1="lat", lng1="lng", lat2="qlat", lng2="qlng")
    + " AS m FROM p, q) QUALIFY place <= 5",
)
def _(t):
    """Five nearest of all customers for every supplier; four of five customers and all suppliers within a hundred metres."""
    k = F.col("c_custkey")
    far = k % 5 == 0
    points = t.star("customer").select(
        k.alias("id"),
        F.when(far, -34 + (k % 390) / F.lit(10.0)).otherwise(-23.55 + (k % 997) / F.lit(1000000.0)).alias("lat"),
        F.when(far, -74 + (k % 400) / F.lit(10.0)).otherwise(-46.63 + (k % 991) / F.lit(1000000.0)).alias("lng"),
    )
    k = F.col("s_suppkey")
    queries = t.star("supplier").select(
        k.alias("query"), (-23.55 + (k % 1009) / F.lit(1000000.0)).alias("qlat"), (-46.63 + (k % 1013) / F.lit(1000000.0)).alias("qlng")
    )
    found = geo.nearest_each(points, queries, "lat", "lng", "qlat", "qlng", "query", 5, ["id"])
    metres = geo.sphere_m(F.col("lat"), F.col("lng"), F.col("qlat"), F.col("qlng"))
    return found.select("query", "id", F.col("place").cast("bigint").alias("place"), F.round(metres, 2).alias("metres"))


@case(
    "g03_nearest_many",
    "SELECT geolocation_zip_code_prefix AS zip, geolocation_city AS city, geolocation_state AS state, round("
    + _SPHERE.format(lat1="geolocation_lat", lng1="geolocation_lng", lat2="-12.97::DOUBLE", lng2="-38.5::DOUBLE")
    + ", 2) AS metres FROM c_geolocations ORDER BY round("
    + _SPHERE.format(lat1="geolocation_lat", lng1="geolocation_lng", lat2="-12.97::DOUBLE", lng2="-38.5::DOUBLE")
    + ", 3), 1, 2, 3 LIMIT 100",
)
def _(t):
    """Ranking and distance on the sphere."""
    lat, lng = F.col("geolocation_lat"), F.col("geolocation_lng")
    found = geo.nearest(
        t["geolocations"],
        "geolocation_lat",
        "geolocation_lng",
        -12.97,
        -38.5,
        100,
        ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"],
    )
    return found.select(
        F.col("geolocation_zip_code_prefix").alias("zip"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
        F.round(geo.sphere_m(lat, lng, F.lit(-12.97), F.lit(-38.5)), 2).alias("metres"),
    )


@case(
    "g04_geojson_text",
    """SELECT geolocation_zip_code_prefix AS zip, 'Point' AS type, geolocation_lng AS lng, geolocation_lat AS lat FROM c_geolocations""",
)
def _(t):
    """Points written as GeoJSON text and read back."""
    made = geo.geojson_point(F.col("geolocation_lng"), F.col("geolocation_lat"))
    text_form = t["geolocations"].select(
        F.col("geolocation_zip_code_prefix").alias("zip"), F.to_json(made).alias("j")
    )
    parsed = text_form.select(
        "zip", F.from_json("j", "type string, coordinates array<double>").alias("p")
    )
    return parsed.select(
        "zip", "p.type", F.col("p.coordinates")[0].alias("lng"), F.col("p.coordinates")[1].alias("lat")
    )
