"""Sources, sinks, table upkeep and change events. Each writes to a fresh shared path first."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.catalog import case
from storelens.functions import geo
from storelens.operators import quality
from storelens.plans import documents, lookups, reports
from storelens.session import fresh_path
from storelens.sinks import layout, merging, summaries, upserts
from storelens.sources import readers, scans
from storelens.streaming import outbox

LO, HI = "1996-01-01", "2000-01-01"
TS = "order_purchase_timestamp"

# -- sources ---------------------------------------------------------------------------


@case(
    "s01_csv_round_trip",
    "SELECT order_item_id, product_id, order_id, CAST(price AS DOUBLE) AS price, shipping_limit_date FROM c_order_items",
)
def _(t):
    path = fresh_path(t.spark, "s01")
    t["order_items"].write.option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
    ).csv(path)
    schema = (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp, price decimal(12,2), freight_value decimal(12,2)"
    )
    rows = readers.read_csv(t.spark, path, schema)
    return rows.select(
        "order_item_id",
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("price").cast("double").alias("price"),
        F.col("shipping_limit_date").cast("timestamp_ntz").alias("shipping_limit_date"),
    )


@case(
    "s01_csv_with_line_breaks",
    """SELECT review_id, review_score, md5(review_comment_message) AS digest, CAST(length(review_comment_message) AS INTEGER) AS chars
    FROM c_text_reviews""",
)
def _(t):
    path = fresh_path(t.spark, "s01b")
    t["text_reviews"].write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = (
        "review_id bigint, order_id bigint, review_score int, review_comment_title string, "
        "review_comment_message string"
    )
    rows = readers.read_csv(t.spark, path, schema, multiline=True)
    return rows.select(
        "review_id",
        "review_score",
        F.md5("review_comment_message").alias("digest"),
        F.char_length("review_comment_message").alias("chars"),
    )


@case(
    "s02_column_defaults",
    """SELECT review_id, coalesce(review_comment_title, 'untitled') AS review_comment_title, 0 AS retries,
    0 AS tags FROM c_order_reviews""",
)
def _(t):
    filled = readers.with_defaults(
        t["order_reviews"],
        {
            "review_comment_title": F.lit("untitled"),
            "retries": F.lit(0),
            "review_tags": F.array().cast("array<string>"),
        },
    )
    return filled.select(
        "review_id", "review_comment_title", "retries", F.size("review_tags").alias("tags")
    )


@case(
    "s03_array_text",
    "SELECT product_id, CAST(len(search_tokens) AS INTEGER) AS n, array_to_string(list_reverse(search_tokens), '+') AS tokens FROM c_products",
)
def _(t):
    text = F.concat(F.lit("{"), F.concat_ws(",", "search_tokens"), F.lit("}"))
    parsed = t["products"].select("product_id", readers.parse_array_text(text).alias("a"))
    return parsed.select(
        "product_id", F.size("a").alias("n"), F.concat_ws("+", F.reverse("a")).alias("tokens")
    )


@case(
    "s03_json_text",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def _(t):
    parsed = t.star("events").select("event_id", readers.parse_json_text(F.col("props")).alias("v"))
    return parsed.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"))


@case(
    "s03_range_text",
    """SELECT promotion_id, seller_id, form, CASE WHEN form IN (0, 1, 2) THEN period_lo WHEN form = 3 THEN period_lo + INTERVAL 1 MICROSECOND
      WHEN form = 4 THEN NULL ELSE TIMESTAMP '1970-01-01' END AS period_lo,
    CASE WHEN form IN (0, 4) THEN period_hi WHEN form IN (1, 3) THEN period_hi + INTERVAL 1 MICROSECOND
      WHEN form = 2 THEN NULL ELSE TIMESTAMP '1970-01-01' END AS period_hi, form <> 6 AS valid
    FROM (SELECT *, CAST(promotion_id % 7 AS INTEGER) AS form FROM c_product_promotions)""",
)
def _(t):
    """Closed, half-open and open-ended ranges, the empty one, and text that is none."""
    side = lambda c: F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit('"'))
    lo, hi = side("period_lo"), side("period_hi")
    form = (F.col("promotion_id") % 7).cast("int")
    text = (
        F.when(form == 0, F.concat(F.lit("["), lo, F.lit(","), hi, F.lit(")")))
        .when(form == 1, F.concat(F.lit("["), lo, F.lit(","), hi, F.lit("]")))
        .when(form == 2, F.concat(F.lit("["), lo, F.lit(",)")))
        .when(form == 3, F.concat(F.lit("("), lo, F.lit(","), hi, F.lit("]")))
        .when(form == 4, F.concat(F.lit("(,"), hi, F.lit(")")))
        .when(form == 5, F.lit("empty"))
        .otherwise(F.concat(F.lit("["), lo, F.lit(",soon)")))
    )
    parsed = t["product_promotions"].select(
        "promotion_id", "seller_id", form.alias("form"), readers.parse_range_text(text).alias("p")
    )
    return parsed.select(
        "promotion_id",
        "seller_id",
        "form",
        F.col("p.lo").cast("timestamp_ntz").alias("period_lo"),
        F.col("p.hi").cast("timestamp_ntz").alias("period_hi"),
        "p.valid",
    )


@case(
    "s01_rejected_rows",
    "SELECT order_id, order_item_id, product_id % 10 = 0 AS rejected FROM c_order_items",
)
def _(t):
    """A price that is no number sends its row to the rejects, whole."""
    path = fresh_path(t.spark, "s01c")
    price = F.when(F.col("product_id") % 10 == 0, F.lit("free")).otherwise(F.col("price").cast("string"))
    t["order_items"].select("order_id", "order_item_id", price.alias("price")).write.option(
        "header", True
    ).csv(path)
    good, bad = readers.read_csv_with_rejects(
        t.spark, path, "order_id bigint, order_item_id int, price decimal(12,2)"
    )
    cells = F.split("_corrupt_record", ",")
    told = bad.select(
        "price", cells[0].cast("bigint").alias("order_id"), cells[1].cast("int").alias("order_item_id"), F.lit(True).alias("rejected")
    )
    return good.select("order_id", "order_item_id", F.lit(False).alias("rejected")).unionByName(
        told.select("order_id", "order_item_id", "rejected")
    )


@case(
    "k01_load_reviews",
    """SELECT review_id, CASE WHEN review_id % 3 = 0 THEN review_score + 10 ELSE review_score END AS review_score, review_id % 3 = 0 AS loaded
    FROM c_order_reviews""",
)
def _(t):
    """A third of the reviews comes again, twice each: one document per review, the last version."""
    base = documents.order_reviews(t).withColumn("version", F.lit(0))
    again = base.filter(F.col("review_id") % 3 == 0)
    versions = again.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "review_score", F.col("review_score") + 5 * F.col("version")
    )
    loaded = documents.load(base, versions, "review_id", ["version"])
    return loaded.select("review_id", "review_score", (F.col("version") > 0).alias("loaded"))


@case(
    "s04_rejected_documents",
    "SELECT event_id, event_type = 'error' AS rejected FROM events",
)
def _(t):
    """Lines that are no JSON go to the rejects as they are."""
    path = fresh_path(t.spark, "s04b")
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), "event_id")).otherwise(
        F.to_json(F.struct("event_id"))
    )
    t.star("events").select(line.alias("value")).write.text(path)
    good, bad = readers.read_docs_with_rejects(t.spark, path, "event_id bigint")
    told = bad.select("event_id", F.regexp_extract("_corrupt_record", r"(\d+)$", 1).cast("bigint").alias("id"))
    return good.select("event_id", F.lit(False).alias("rejected")).unionByName(
        told.select(F.col("id").alias("event_id"), F.lit(True).alias("rejected"))
    )


@case(
    "s04_nested_documents",
    """SELECT order_id, status, state, CAST(total_value AS DOUBLE) AS total_value, payment_types, max_installments
    FROM c_orders_analytics""",
)
def _(t):
    path = fresh_path(t.spark, "s04")
    docs = documents.orders_analytics(t)
    docs.write.json(path)
    back = readers.read_docs(t.spark, path, docs.schema)
    return back.select(
        "order_id",
        "status",
        "customer.state",
        F.col("payment_summary.total_value").cast("double").alias("total_value"),
        F.concat_ws(",", "payment_summary.payment_types").alias("payment_types"),
        "payment_summary.max_installments",
    )


def _partitioned(t, unit="month"):
    path = fresh_path(t.spark, f"orders-by-{unit}")
    layout.write_partitioned(t["orders"], path, TS, unit, LO, HI)
    return path


@case(
    "s05_partitioned_range_scan",
    f"""SELECT order_id, order_status, {TS} FROM c_orders WHERE {TS} >= TIMESTAMP '1995-12-15' AND {TS} < TIMESTAMP '1997-06-10'""",
)
def _(t):
    rows = scans.scan_range(
        t.spark, _partitioned(t), TS, "1995-12-15", "1997-06-10", "month", LO, HI
    )
    return rows.select("order_id", "order_status", TS)


@case(
    "s06_sorted_range_scan",
    f"""SELECT order_id, order_status, {TS} FROM c_orders WHERE {TS} >= TIMESTAMP '1997-06-01' AND {TS} < TIMESTAMP '1997-07-01'""",
)
def _(t):
    path = fresh_path(t.spark, "s06")
    layout.write_sorted(t["orders"], path, [TS, "order_id"])
    rows = scans.scan_sorted_range(t.spark, path, TS, "1997-06-01", "1997-07-01")
    return rows.select("order_id", "order_status", TS)


@case(
    "s07_saved_subset",
    "SELECT event_id, created_at FROM c_outbox_events WHERE processed_at IS NULL",
)
def _(t):
    path = fresh_path(t.spark, "s07")
    layout.materialize_subset(
        t["outbox_events"], F.col("processed_at").isNull(), ["created_at", "event_id"], path
    )
    return t.spark.read.parquet(path).select("event_id", "created_at")


# -- sinks and upkeep ------------------------------------------------------------------

_LAST_ITEM = """(SELECT l_partkey, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, l_shipdate, l_orderkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1)"""


def _updates(t):
    return t.star("lineitem").select(
        F.col("l_partkey").alias("id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        F.col("l_shipdate").alias("at"),
        F.col("l_orderkey").alias("source_order"),
        F.col("l_linenumber").alias("line"),
    )


@case(
    "k01_upsert",
    f"""SELECT coalesce(u.l_partkey, c.c_custkey) AS id, c.c_mktsegment AS label,
    CAST(CASE WHEN u.l_partkey IS NOT NULL THEN u.amount ELSE CAST(c.c_acctbal AS DECIMAL(12,2)) END AS DOUBLE) AS amount,
    u.l_orderkey AS source_order FROM customer c FULL JOIN {_LAST_ITEM} u ON u.l_partkey = c.c_custkey""",
)
def _(t):
    base = t.star("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("label"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("amount"),
    )
    merged = upserts.upsert(base, _updates(t), ["id"], ["at", "source_order", "line", "amount"])
    path = fresh_path(t.spark, "k01")
    layout.reload(merged, path)
    return t.spark.read.parquet(path).select(
        "id", "label", F.col("amount").cast("double").alias("amount"), "source_order"
    )


_TOUCHED_SQL = f"""WITH u AS (SELECT o_orderkey AS order_id, 'X' AS order_status, CAST(NULL AS TIMESTAMP) AS moved FROM orders
      WHERE strftime(o_orderdate, '%Y-%m') = '1997-03'
    UNION ALL SELECT o_orderkey, 'M', o_orderdate + INTERVAL 31 DAY FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1996-05'
    UNION ALL SELECT -c_custkey, 'N', TIMESTAMP '1998-07-01' FROM customer),
    o AS (SELECT coalesce(o.o_orderkey, u.order_id) AS order_id, coalesce(u.order_status, o.o_orderstatus) AS order_status,
      coalesce(u.moved, o.o_orderdate) AS ts FROM orders o FULL JOIN u ON u.order_id = o.o_orderkey)
    SELECT order_id, order_status, ts, CASE WHEN ts >= TIMESTAMP '{LO}' AND ts < TIMESTAMP '{HI}' THEN strftime(ts, '%Y_%m') ELSE 'default' END AS part FROM o"""


@case("k01_touched_buckets", _TOUCHED_SQL)
def _(t):
    """Orders in monthly buckets: one month gets a status, one moves on by 31 days, and one gets new rows."""
    orders = t["orders"].select("order_id", "order_status", F.col(TS).alias("ts"))
    table = merging.BucketTable(fresh_path(t.spark, "k01-touched"), "order_id bigint, order_status string, ts timestamp_ntz", ("order_id",), "ts", LO, HI)
    merging.create(orders, table)
    month = F.date_format("ts", "yyyy-MM")
    none = F.lit(None).cast("timestamp_ntz")
    new = t["customers"].select((-F.col("customer_id")).alias("order_id"), F.lit("N").alias("order_status"), F.lit("1998-07-01").cast("timestamp_ntz").alias("ts"))
    updates = (
        orders.filter(month == "1997-03").select("order_id", F.lit("X").alias("order_status"), none.alias("ts"))
        .unionByName(orders.filter(month == "1996-05").select("order_id", F.lit("M").alias("order_status"), (F.col("ts") + F.expr("INTERVAL 31 DAY")).alias("ts")))
        .unionByName(new)
    )
    merging.merge(t.spark, table, updates, ["order_status"], keep_when_null=True)
    return table.rows(t.spark)


@case(
    "k02_full_reload",
    "SELECT event_id, event_type FROM events",
)
def _(t):
    path = fresh_path(t.spark, "k02")
    layout.reload(t.star("events").select("event_id").withColumn("event_type", F.lit("old")), path)
    layout.reload(t.star("events").select("event_id", "event_type"), path)
    return t.spark.read.parquet(path)


@case(
    "k03_insert_ignore",
    f"""SELECT c_custkey AS id, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM customer UNION ALL
    SELECT l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) FROM lineitem
    WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) = 1""",
)
def _(t):
    base = t.star("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").cast("decimal(12,2)").alias("amount")
    )
    merged = upserts.insert_ignore(base, _updates(t), ["id"], ["at", "source_order", "line", "amount"])
    return merged.withColumn("amount", F.col("amount").cast("double"))


_PARTS = """SELECT CASE WHEN {ts} >= TIMESTAMP '1996-01-01' AND {ts} < TIMESTAMP '2000-01-01'
    THEN strftime({ts}, '{fmt}') ELSE 'default' END AS part, count(*) AS rows FROM c_orders GROUP BY 1"""


@case("k04_copy_partitioned", _PARTS.format(ts=TS, fmt="%Y_%m"))
def _(t):
    path = fresh_path(t.spark, "k04")
    layout.copy_into_partitioned(
        t["orders"], ["order_id", "customer_id", "order_status", TS], path, TS, "month", LO, HI
    )
    return quality.rows_per_partition(scans.read_partitioned(t.spark, path))


@case("k05_year_buckets", _PARTS.format(ts=TS, fmt="%Y"))
def _(t):
    bucket = layout.range_bucket(F.col(TS), "year", LO, HI)
    return quality.rows_per_partition(t["orders"].withColumn("part", bucket))


@case("k06_month_buckets", _PARTS.format(ts=TS, fmt="%Y_%m"))
def _(t):
    bucket = layout.range_bucket(F.col(TS), "month", LO, HI)
    return quality.rows_per_partition(t["orders"].withColumn("part", bucket))


@case("k07_sorted_copy", f"SELECT order_id, {TS}, order_status FROM c_orders")
def _(t):
    path = fresh_path(t.spark, "k07")
    layout.write_sorted(t["orders"].select("order_id", TS, "order_status"), path, [TS, "order_id"])
    return t.spark.read.parquet(path)


@case(
    "k08_fill_point",
    """SELECT product_id, product_width_cm IS NOT NULL AS placed, CASE WHEN product_width_cm IS NOT NULL
    THEN product_length_cm END AS lng FROM c_products""",
)
def _(t):
    filled = layout.fill_point(
        t["products"], geo.point(F.col("product_length_cm"), F.col("product_width_cm"))
    )
    return filled.select(
        "product_id",
        F.col("geo_point").isNotNull().alias("placed"),
        F.col("geo_point.lng").alias("lng"),
    )


@case(
    "k09_stamp_changes",
    """SELECT coalesce(c.c_custkey, p.p_partkey) AS id, CASE WHEN p.p_partkey IS NULL THEN c.size ELSE p.p_size END AS size,
    CASE WHEN p.p_partkey IS NOT NULL AND (c.c_custkey IS NULL OR c.size <> p.p_size) THEN TIMESTAMP '2018-09-01'
    ELSE TIMESTAMP '2018-01-01' END AS updated_at
    FROM (SELECT c_custkey, c_nationkey AS size FROM customer) c FULL JOIN part p ON p.p_partkey = c.c_custkey""",
)
def _(t):
    base = t.star("customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("size"),
        F.lit("2018-01-01").cast("timestamp_ntz").alias("updated_at"),
    )
    updates = t.star("part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"))
    now = F.lit("2018-09-01").cast("timestamp_ntz")
    return upserts.upsert(base, updates, ["id"], ["size"], stamp=("updated_at", now))


@case(
    "k10_refresh_summary",
    """SELECT c.customer_state, CAST(date_trunc('month', o.order_purchase_timestamp) AS TIMESTAMP) AS purchase_month,
    o.order_status, count(*) AS total_orders, strftime(o.order_purchase_timestamp, '%Y_%m') AS month_key
    FROM c_orders o JOIN c_customers c USING (customer_id) GROUP BY ALL""",
)
def _(t):
    path = fresh_path(t.spark, "k10")
    summary = reports.monthly_summary(t).withColumn(
        "month_key", F.date_format("purchase_month", "yyyy_MM")
    )
    stale = summary.withColumn("total_orders", F.lit(0).cast("bigint"))
    layout.refresh_summary(stale.hint("rebalance", "month_key"), path, "month_key")
    layout.refresh_summary(summary.hint("rebalance", "month_key"), path, "month_key")
    return scans.read_partitioned(t.spark, path, "month_key")


@case(
    "k10_incremental_summary",
    """WITH i AS (SELECT l_partkey % 50 AS grp, l_returnflag AS kind, CAST(CASE WHEN l_linenumber = 3 THEN l_extendedprice * 2
      ELSE l_extendedprice END AS DECIMAL(12,2)) AS price FROM lineitem WHERE l_linenumber <> 1
    UNION ALL SELECT p_size % 50, NULL, CAST(p_retailprice AS DECIMAL(12,2)) FROM part)
    SELECT grp, kind, count(*) AS n, count(price) AS price_known, CAST(sum(price) AS DOUBLE) AS price_sum, CAST(min(price) AS DOUBLE) AS price_min,
    CAST(max(price) AS DOUBLE) AS price_max FROM i GROUP BY ALL""",
)
def _(t):
    """Item prices per group: first lines are deleted, third lines cost twice as much, products come in; the saved summary follows."""
    price = F.col("l_extendedprice")
    shape = lambda df, price: df.select((F.col("l_partkey") % 50).alias("grp"), F.col("l_returnflag").alias("kind"), price.cast("decimal(12,2)").alias("price"))
    items = t.star("lineitem")
    first, third = F.col("l_linenumber") == 1, F.col("l_linenumber") == 3
    path = fresh_path(t.spark, "k10-summary")
    summaries.build(shape(items, price), ["grp", "kind"], ["price"]).write.parquet(path)
    products = t.star("part").select(
        (F.col("p_size") % 50).cast("bigint").alias("grp"), F.lit(None).cast("string").alias("kind"), F.col("p_retailprice").cast("decimal(12,2)").alias("price")
    )
    gone = shape(items.filter(first | third), price)
    came = shape(items.filter(third), price * 2).unionByName(products)
    after = shape(items.filter(~first), F.when(third, price * 2).otherwise(price)).unionByName(products)
    fresh = summaries.refresh(t.spark.read.parquet(path), summaries.changes(gone, came), ["grp", "kind"], ["price"], after)
    return fresh.select("grp", "kind", "n", "price_known", *(F.col(f"price_{x}").cast("double").alias(f"price_{x}") for x in ("sum", "min", "max")))


@case(
    "k11_retention",
    f"SELECT order_id FROM c_orders WHERE {TS} >= TIMESTAMP '1999-08-01'",
)
def _(t):
    return layout.apply_retention(t["orders"], TS, 24, "2001-08-01").select("order_id")


@case(
    "k11_drop_old_partitions",
    f"""SELECT order_id FROM c_orders WHERE {TS} >= TIMESTAMP '1998-01-01' OR {TS} < TIMESTAMP '{LO}' OR {TS} >= TIMESTAMP '{HI}'""",
)
def _(t):
    kept = layout.drop_old_partitions(t.spark, _partitioned(t), 24, "2000-01-01")
    return kept.select("order_id")


@case(
    "k12_csv_report",
    """SELECT payment_type, count(*) AS total_payments, CAST(sum(payment_value) AS DOUBLE) AS total_value
    FROM c_order_payments WHERE payment_value > 0 GROUP BY 1""",
)
def _(t):
    path = fresh_path(t.spark, "k12")
    layout.write_report(reports.payments_by_type(t), path)
    back = readers.read_csv(
        t.spark,
        path,
        "payment_type string, total_payments bigint, total_value decimal(22,2), avg_value decimal(16,6)",
    )
    return back.select(
        "payment_type", "total_payments", F.col("total_value").cast("double").alias("total_value")
    )


_MONTH = f"SELECT count(*) AS orders FROM c_orders WHERE {TS} >= TIMESTAMP '1997-06-01' AND {TS} < TIMESTAMP '1997-07-01'"


@case("b5_month_count_sorted", _MONTH)
def _(t):
    path = fresh_path(t.spark, "b5s")
    layout.write_sorted(t["orders"], path, [TS, "order_id"])
    return lookups.month_count(t.spark.read.parquet(path), "1997-06")


@case("b5_month_count_partitioned", _MONTH)
def _(t):
    rows = scans.scan_range(
        t.spark, _partitioned(t), TS, "1997-06-01", "1997-07-01", "month", LO, HI
    )
    return lookups.month_count(rows, "1997-06")


@case("b7_status_from_partitions", "SELECT order_status FROM c_orders WHERE order_id = 777")
def _(t):
    return lookups.order_status(scans.read_partitioned(t.spark, _partitioned(t)), 777)


@case("b7_status_by_id", "SELECT order_status FROM c_orders WHERE order_id IN (777, 4)")
def _(t):
    path = fresh_path(t.spark, "b7-ids")
    layout.write_by_id(t["orders"].select("order_id", "order_status"), path, "order_id", 32)
    read = lambda i: scans.read_by_id(t.spark, path, "order_id bigint, order_status string", "order_id", i, 32)
    return lookups.order_status(read(777), 777).unionAll(lookups.order_status(read(4), 4))


# -- change events ---------------------------------------------------------------------


@case(
    "st1_pending_events",
    "SELECT event_id, payload, created_at FROM c_outbox_events WHERE processed_at IS NULL",
)
def _(t):
    events = t["outbox_events"]
    handled = events.filter(F.col("processed_at").isNotNull()).select("event_id")
    return outbox.pending(events, handled).select("event_id", "payload", "created_at")


@case(
    "st1_pending_since_mark",
    "SELECT event_id, payload, created_at FROM c_outbox_events WHERE processed_at IS NULL AND created_at >= (SELECT min(created_at)::DATE + CAST(date_diff('day', min(created_at)::DATE, max(created_at)::DATE) // 2 AS INTEGER) FROM c_outbox_events)",
)
def _(t):
    """Pending events from a low-water mark on, from laid-out events and ids: the first half is not read."""
    events = t["outbox_events"]
    days = (F.to_date(f("created_at")) for f in (F.min, F.max))
    first, last = events.agg(*days).first()
    mark = (first + (last - first) // 2).strftime("%Y-%m-%d")
    path = fresh_path(t.spark, "st1-events")
    layout.write_sorted(events, path, ["created_at", "event_id"])
    handled = events.filter(F.col("processed_at").isNotNull()).select("event_id")
    return outbox.pending(t.spark.read.parquet(path), handled, mark).select("event_id", "payload", "created_at")


@case("st1_pending_count", "SELECT count(*) AS pending FROM c_outbox_events WHERE processed_at IS NULL")
def _(t):
    return outbox.pending_count(t["outbox_events"])


def _event_files(t, broken: bool):
    """The events as JSON files, as a change feed would leave them."""
    path = fresh_path(t.spark, "feed")
    payload = F.col("payload")
    if broken:
        payload = F.when(F.col("event_type") == "error", F.lit("{not json")).otherwise(payload)
    t["outbox_events"].select(
        F.col("event_id").cast("string").alias("event_id"),
        "aggregate_type",
        F.col("aggregate_id").cast("string").alias("aggregate_id"),
        "event_type",
        payload.alias("payload"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        "retries",
    ).repartition(4, "event_id").write.json(path)
    return path


def _applied(t, broken: bool = False, feed: str | None = None, body: str = "k int"):
    """Run the job over all event files, in batches of one file, then once more."""
    root = fresh_path(t.spark, "documents")
    feed = feed or _event_files(t, broken)
    for _ in range(2):
        stream = outbox.read_events(t.spark, feed, max_files=1)
        outbox.apply_events(stream, root, body, f"{root}/checkpoint").awaitTermination()
    return root


def _partial_event_files(t):
    """Events of two types; clicks carry only ``k``, errors an explicit null, the others only their kind."""
    path = fresh_path(t.spark, "feed")
    events = t["outbox_events"].withColumn("k", F.get_json_object("payload", "$.k").cast("int"))
    kind = F.col("event_type")
    payload = (
        F.when(kind == "click", F.to_json(F.struct("k")))
        .when(kind == "error", F.lit('{"kind":null}'))
        .otherwise(F.to_json(F.struct(kind.alias("kind"))))
    )
    events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_id") % 2 == 0, "user").otherwise("product").alias("aggregate_type"),
        F.col("aggregate_id").cast("string").alias("aggregate_id"),
        "event_type",
        payload.alias("payload"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        "retries",
    ).repartition(3, "event_id").write.json(path)
    return path


_PARTIAL = """SELECT CASE WHEN event_id % 2 = 0 THEN 'user' ELSE 'product' END AS aggregate_type, aggregate_id,
    arg_max(CAST(json_extract(payload, '$.k') AS INTEGER), (created_at, CAST(event_id AS VARCHAR)))
      FILTER (event_type = 'click') AS k,
    nullif(arg_max(CASE WHEN event_type = 'error' THEN 'null' ELSE event_type END, (created_at, CAST(event_id AS VARCHAR)))
      FILTER (event_type <> 'click'), 'null') AS kind FROM c_outbox_events GROUP BY 1, 2"""


@case("st2_partial_payloads", _PARTIAL)
def _(t):
    root = _applied(t, feed=_partial_event_files(t), body="k int, kind string")
    docs = outbox.current_documents(t.spark, root)
    return docs.select("aggregate_type", F.col("aggregate_id").cast("bigint").alias("aggregate_id"), "k", "kind")


@case(
    "st2_two_types",
    f"""SELECT c_custkey AS id, c_mktsegment AS label, e.k, e.kind FROM customer FULL JOIN
    (SELECT * FROM ({_PARTIAL}) WHERE aggregate_type = 'product') e ON e.aggregate_id = c_custkey""",
)
def _(t):
    """Only the documents of one type reach its table, although ids are shared."""
    root = _applied(t, feed=_partial_event_files(t), body="k int, kind string")
    compacted = fresh_path(t.spark, "documents")
    outbox.compact(t.spark, root, compacted)
    base = t.star("customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("label")
    )
    folded = outbox.fold_into(base, outbox.current_documents(t.spark, compacted), "id", "product")
    return folded.select(F.col("id").cast("bigint").alias("id"), "label", "k", "kind")


@case(
    "st2_apply_events",
    """SELECT aggregate_id, CAST(json_extract(payload, '$.k') AS INTEGER) AS k, created_at AS updated_at FROM c_outbox_events
    QUALIFY row_number() OVER (PARTITION BY aggregate_id ORDER BY created_at DESC, CAST(event_id AS VARCHAR) DESC) = 1""",
)
def _(t):
    docs = outbox.current_documents(t.spark, _applied(t))
    return docs.select(
        F.col("aggregate_id").cast("bigint").alias("aggregate_id"),
        "k",
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


@case(
    "st2_fold_into_documents",
    """SELECT c_custkey AS id, c_mktsegment AS label, CAST(json_extract(e.payload, '$.k') AS INTEGER) AS k FROM customer FULL JOIN
    (SELECT * FROM c_outbox_events QUALIFY row_number() OVER (PARTITION BY aggregate_id ORDER BY created_at DESC,
    CAST(event_id AS VARCHAR) DESC) = 1) e ON e.aggregate_id = c_custkey""",
)
def _(t):
    base = t.star("customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("label")
    )
    changes = outbox.current_documents(t.spark, _applied(t))
    folded = outbox.fold_into(base, changes, "id", "user")
    return folded.select(F.col("id").cast("bigint").alias("id"), "label", "k")


@case(
    "st3_rejected_events",
    "SELECT event_id, 1 AS retries FROM c_outbox_events WHERE event_type = 'error'",
)
def _(t):
    bad = outbox.rejected(t.spark, _applied(t, broken=True))
    return bad.select(F.col("event_id").cast("bigint").alias("event_id"), "retries")
