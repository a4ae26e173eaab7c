"""The model's rule sets on small tables with one violation of each kind."""

import datetime as dt
from decimal import Decimal

import pytest

from storelens import schemas
from storelens.operators import model_rules

DAY = dt.datetime(2018, 1, 2)


@pytest.fixture
def tables(spark):
    frame = spark.createDataFrame
    one, two = Decimal("1.00"), Decimal("-2.00")
    return {
        "geo_locations": frame([(1, "x", "SP", 0.0, 0.0), (2, "x", "sp", 91.0, 181.0)], "zip_code_prefix int, city string, state string, latitude double, longitude double"),
        "customers": frame([("c1", "u", 1, "x", "SP"), ("c1", "u", 9, None, "S"), ("c2", "u", None, "x", "RJ")], schemas.CUSTOMERS),
        "sellers": frame([("s1", 1, "x", "SP"), (None, 2, "x", "SP")], schemas.SELLERS),
        "products": frame([("p1", "a", None, None, None, -1.0, 1.0, None, 0.0)], schemas.PRODUCTS),
        "orders": frame(
            [("o1", "c1", "delivered", DAY, DAY, None, None, None), ("o2", "c9", "lost", DAY, DAY - dt.timedelta(1), None, None, None), ("o3", None, None, None, None, None, None, None)],
            schemas.ORDERS,
        ),
        "order_items": frame([("o1", 1, "p1", "s1", DAY, one, two), ("o1", 1, "p1", "s9", DAY, one, one), ("o9", 1, "p9", "s1", DAY, None, one)], schemas.ORDER_ITEMS),
        "order_payments": frame([("o1", 1, "boleto", -1, one), ("o1", 2, "cash", 1, two)], schemas.ORDER_PAYMENTS),
        "order_reviews": frame([("r1", "o1", 0, None, None, None, None), ("r2", "o9", 5, None, None, None, None)], schemas.ORDER_REVIEWS),
        "product_promotions": frame(
            [(1, "p1", "s1", DAY, DAY + dt.timedelta(5), Decimal("0.00")), (2, "p1", "s1", DAY + dt.timedelta(2), None, Decimal("50.00"))],
            "promotion_id int, product_id string, seller_id string, period_lo timestamp, period_hi timestamp, discount_percentage decimal(5,2)",
        ),
        "outbox_events": frame([("e1", "order", "o1", "t", "{}", -1), ("e2", None, "o1", "t", "{}", None)], "event_id string, aggregate_type string, aggregate_id string, event_type string, payload string, retries int"),
    }


WANT = {
    ("customers", "unique:customer_id", "c1"), ("customers", "foreign:customer_zip_code_prefix", "9"), ("customers", "not_null:customer_city", "c1"), ("customers", "pattern:customer_state", "c1"),
    ("sellers", "not_null:seller_id", "null"), ("geo_locations", "pattern:state", "2"), ("geo_locations", "range:latitude", "2"), ("geo_locations", "range:longitude", "2"),
    ("products", "range:product_weight_g", "p1"), ("orders", "foreign:customer_id", "c9"), ("orders", "domain:order_status", "o2"),
    ("orders", "order:order_approved_at>=order_purchase_timestamp", "o2"), ("orders", "not_null:customer_id", "o3"), ("orders", "not_null:order_status", "o3"), ("orders", "not_null:order_purchase_timestamp", "o3"),
    ("order_items", "unique:order_id,order_item_id", "o1|1"), ("order_items", "range:freight_value", "o1|1"), ("order_items", "foreign:seller_id", "s9"), ("order_items", "foreign:order_id", "o9"),
    ("order_items", "foreign:product_id", "p9"), ("order_items", "not_null:price", "o9|1"), ("order_payments", "range:payment_installments", "o1|1"), ("order_payments", "domain:payment_type", "o1|2"),
    ("order_payments", "range:payment_value", "o1|2"), ("order_reviews", "range:review_score", "r1"), ("order_reviews", "foreign:order_id", "o9"),
    ("product_promotions", "range:discount_percentage", "1"), ("product_promotions", "apart:product_id,period_lo,period_hi", "p1|2018-01-04 00:00:00"),
    ("outbox_events", "range:retries", "e1"), ("outbox_events", "not_null:aggregate_type", "e2"),
}


def test_every_rule_finds_its_violation(tables):
    found = model_rules.check_tables(tables)
    assert {(r.tbl, r.check, r.key) for r in found.collect()} == WANT
    counted = {(r.tbl, r.check): r.keys for r in model_rules.summary(found).collect()}
    assert counted[("orders", "not_null:customer_id")] == 1 and sum(counted.values()) == len(WANT)


def test_only_what_is_there_is_checked(tables):
    some = {"order_items": tables["order_items"].drop("price")}
    assert {r.check for r in model_rules.check_tables(some).collect()} == {"unique:order_id,order_item_id", "range:freight_value"}


def test_typed_tables(spark, tables):
    raw = {"orders": spark.createDataFrame([("o1", "2018-01-02 00:00:00", "kept")], "order_id string, order_purchase_timestamp string, note string"), "other": tables["sellers"]}
    out = model_rules.typed(raw)
    declared = spark.createDataFrame([], schemas.ORDERS).schema
    assert out["orders"].schema.fields[: len(declared)] == declared.fields and out["orders"].columns[-1] == "note"
    assert out["orders"].first().order_purchase_timestamp == DAY and out["other"] is raw["other"]
    bad = model_rules.typed({"order_reviews": spark.createDataFrame([("r", "many")], "review_id string, review_score string")})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad["order_reviews"].collect()
