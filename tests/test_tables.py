"""Sinks, layouts, document builders, two-form queries and change events."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from storelens.operators import quality
from storelens.plans import collections, documents, lookups, reports
from storelens.sinks import layout, upserts
from storelens.sources import scans
from storelens.streaming import outbox

TS = "order_purchase_timestamp"


def d(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture
def tables(frame):
    """Small commerce tables with the awkward rows: no review, two reviews, no payment, ties."""
    return {
        "orders": frame(
            [
                ("o1", "c1", "delivered", d("2017-01-05"), d("2017-01-08"), d("2017-01-20"), d("2017-01-15")),
                ("o2", "c1", "delivered", d("2017-01-31T23:59:59"), d("2017-02-03"), d("2017-02-08"), d("2017-02-15")),
                ("o3", "c2", "delivered", d("2018-01-01"), None, None, d("2018-01-15")),
                ("o4", "c3", "created", d("2017-03-01"), None, None, d("2017-03-15")),
                ("o5", "c3", "delivered", d("2017-01-05"), None, None, d("2017-03-15")),
            ],
            "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
            "order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz, "
            "order_estimated_delivery_date timestamp_ntz",
        ),
        "customers": frame(
            [("c1", "p1", 1001, "são paulo", "SP"), ("c2", "p1", 1002, "santos", "SP"), ("c3", "p2", 2001, "rio", "RJ"), ("c4", "p3", 2002, "rio", "RJ")],
            "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string",
        ),
        "order_payments": frame(
            [("o1", 1, "voucher", 1, "10.00"), ("o1", 2, "credit_card", 3, "5.50"), ("o1", 3, "voucher", 1, "0.00"), ("o2", 1, "boleto", 1, "7.25")],
            "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value string",
        ).withColumn("payment_value", F.col("payment_value").cast("decimal(12,2)")),
        "order_reviews": frame(
            [
                ("r1", "o1", 5, None, "bom", d("2017-01-25"), d("2017-01-26")),
                ("r2", "o1", 2, "t", None, d("2017-01-25"), None),
                ("r3", "o2", 1, None, "", None, None),
            ],
            "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, "
            "review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz",
        ),
        "order_items": frame(
            [("o1", 1, "p1", "s1", "10.005"), ("o1", 2, "p1", "s1", "10.00"), ("o2", 1, "p2", "s2", "3.00")],
            "order_id string, order_item_id int, product_id string, seller_id string, price string",
        ).withColumn("price", F.col("price").cast("decimal(12,2)")),
        "products": frame(
            [
                ("p1abcdef", "beleza_saude", 40.0, None, 2.0, 225.0, 16.0, 10.0, 14.0),
                ("p2", None, None, None, None, 0.0, None, 10.0, 14.0),
                ("p3", "sem_traducao", 1.0, 2.0, 3.0, 1.5, 1.0, 1.0, 1.0),
            ],
            "product_id string, product_category_name string, product_name_lenght double, product_description_lenght double, "
            "product_photos_qty double, product_weight_g double, product_length_cm double, product_height_cm double, product_width_cm double",
        ),
        "product_categories": frame(
            [("beleza_saude", "health_beauty")], "product_category_name string, product_category_name_english string"
        ),
        "sellers": frame(
            [("s1", 1, "x", "SP"), ("s2", 2, "y", "SP"), ("s3", 3, "z", None), ("s4", 4, "w", "RJ")],
            "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
        ),
    }


def test_reports(tables):
    out = reports.orders_by_state_month(tables).collect()
    assert [(r[0], str(r[1]), r[2]) for r in out] == [("SP", "2017-01-01 00:00:00", 2), ("RJ", "2017-01-01 00:00:00", 1)]
    assert [tuple(r) for r in reports.late_deliveries(tables).collect()] == [("SP", 1)]
    pays = {r[0]: (r[1], float(r[2])) for r in reports.payments_by_type(tables).collect()}
    assert pays == {"voucher": (1, 10.0), "credit_card": (1, 5.5), "boleto": (1, 7.25)}


def test_both_forms_agree(tables):
    day = "2017-01-05"
    assert {tuple(r) for r in lookups.status_of_day(tables, day).collect()} == {
        tuple(r) for r in lookups.status_of_day_truncated(tables, day).collect()
    }
    assert lookups.delivered_without_review(tables, day).first()[0] == 1
    assert lookups.delivered_without_review_not_in(tables, day).first()[0] == 1
    with_null = dict(tables, order_reviews=tables["order_reviews"].withColumn("order_id", F.when(F.col("review_id") != "r3", F.col("order_id"))))
    assert lookups.delivered_without_review(with_null, day).first()[0] == 1
    assert lookups.delivered_without_review_not_in(with_null, day).first()[0] == 0
    assert sorted(map(tuple, lookups.seller_sales(tables).collect())) == sorted(
        map(tuple, lookups.seller_sales_correlated(tables).collect())
    )


def test_customer_history_spans_ids(tables):
    assert [r[0] for r in lookups.customer_history(tables, "p1").collect()] == ["o3", "o2", "o1"]


def test_zip_distance_drops_unknown_zip(frame):
    geo = frame([(1001, 0.0, 0.0), (13050, 0.0, 1.0)], "zip_code_prefix int, latitude double, longitude double")
    assert reports.zip_distance({"geo_locations": geo}).first()["distance_km"] == pytest.approx(111.319, abs=0.001)
    assert reports.zip_distance({"geo_locations": geo}, 1001, 5).count() == 0


def test_order_documents(tables):
    docs = {r["order_id"]: r for r in documents.orders_analytics(tables).collect()}
    pay = docs["o1"]["payment_summary"]
    assert (float(pay["total_value"]), pay["payment_types"], pay["max_installments"]) == (15.5, ["credit_card", "voucher"], 3)
    none = docs["o3"]["payment_summary"]
    assert (float(none["total_value"]), none["payment_types"], none["max_installments"]) == (0.0, [], None)
    assert docs["o2"]["customer"]["state"] == "SP" and docs["o2"]["purchase_year_month"] == "2017-01"


def test_revenue_repeats_per_review(tables):
    out = collections.revenue_groups(documents.orders_analytics(tables), documents.order_reviews(tables)).collect()
    sp = [r for r in out if r["state"] == "SP"][0]
    # o1 twice (two reviews), o2 once
    assert (sp["total_orders"], float(sp["total_revenue"]), sp["avg_review_score"]) == (3, 38.25, 2.67)
    rj = [r for r in out if r["state"] == "RJ"][0]
    assert (rj["total_orders"], float(rj["total_revenue"]), rj["avg_review_score"]) == (1, 0.0, None)


def test_revenue_equals_the_unwound_form(tables):
    from storelens.operators.joins import lookup_unwound

    docs, reviews = documents.orders_analytics(tables), documents.order_reviews(tables)
    plain = lookup_unwound(
        docs.filter("status = 'delivered' AND purchase_ts >= '2017-01-01' AND purchase_ts < '2018-01-01'"), reviews, "order_id", "order_id"
    ).groupBy("customer.state").agg(F.count("*").alias("n"), F.sum("payment_summary.total_value").alias("v"))
    fast = collections.revenue_plain(docs, reviews).groupBy("state").agg(F.sum("total_orders"), F.sum("total_revenue"))
    assert {(r[0], r[1], float(r[2])) for r in plain.collect()} == {(r[0], r[1], float(r[2])) for r in fast.collect()}


def test_low_scores_keep_empty_comments(tables):
    out = [tuple(r) for r in collections.low_score_reviews(documents.order_reviews(tables)).collect()]
    assert out == [("1", 1, 0.0)]


def test_catalog_documents(tables):
    docs = {r["product_id"]: r for r in documents.products_catalog(tables).collect()}
    assert docs["p2"]["category"]["name_pt"] == "unknown" and docs["p2"]["dimensions"]["volume_cm3"] is None
    assert docs["p3"]["category"]["name_en"] is None
    assert [a["v"] for a in docs["p1abcdef"]["attributes"]] == [225.0, 16.0, 10.0, 14.0, 2240.0]
    top = collections.category_attributes(documents.products_catalog(tables)).collect()
    assert [tuple(r) for r in top] == [("health_beauty", 2, 225.0, 2240.0)]
    once = collections.category_attributes_by_product(documents.products_catalog(tables)).collect()
    assert once[0]["product_count"] == 1


def test_enriched_catalog(tables):
    tables = dict(tables, products=tables["products"].withColumn("product_id", F.substring("product_id", 1, 2)))
    docs = {r["product_id"]: r for r in documents.enriched_catalog(tables).collect()}
    p1 = docs["p1"]
    assert p1["name"] == "Producto Beleza Saude - p1" and p1["specifications"] == {"name_length": "40", "photos_qty": "2"}
    assert p1["price"] == 10.0 and p1["computed_metrics"]["total_units_sold"] == 2  # 10.01 and 10.00: a tie goes to even
    assert p1["computed_metrics"]["average_rating"] == 3.5
    assert docs["p3"]["price"] == 0.0 and docs["p3"]["computed_metrics"]["average_rating"] == 0.0
    assert docs["p2"]["category"] == "general"


def test_customer_behavior_uses_the_kept_id(tables):
    now = F.lit("2020-01-01").cast("timestamp_ntz")
    kept = {r[0]: str(r[1]) for r in documents.customer_behavior(tables, now).collect()}
    assert kept == {"p1": "2017-01-31 23:59:59", "p2": "2017-03-01 00:00:00", "p3": "2020-01-01 00:00:00"}
    every = {r[0]: str(r[1]) for r in documents.customer_behavior(tables, now, all_ids=True).collect()}
    assert every["p1"] == "2018-01-01 00:00:00"


def test_seller_metrics(tables):
    out = {r["seller_id"]: r for r in documents.seller_metrics(tables).collect()}
    kpis = out["s1"]["kpis"]
    assert (float(kpis["total_sales"]), kpis["orders"], kpis["avg_shipping_hours"]) == (20.01, 1, 288.0)
    assert out["s1"]["reputation_score"] == 3.5


def test_seller_buckets_split_and_drop_null_states(tables, frame):
    out = {r["state"]: r for r in documents.seller_state_buckets(tables, buckets=1).collect()}
    assert set(out) == {"SP", "RJ"} and out["SP"]["seller_count"] == 2
    many = frame([(f"s{i}", i, "x", "SP") for i in range(500)], "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string")
    split = documents.seller_state_buckets({"sellers": many}, buckets=10).collect()
    assert len(split) == 10 and {r["seller_count"] for r in split} == {500}
    assert sorted(s["seller_id"] for r in split for s in r["sellers"]) == sorted(f"s{i}" for i in range(500))
    assert max(len(r["sellers"]) for r in split) < 120


def test_review_documents_leave_out_absent_fields(tables):
    now = F.lit("2020-01-01").cast("timestamp_ntz")
    docs = {r[0]: json.loads(r[1]) for r in documents.review_documents(tables, now).collect()}
    assert "review_comment_title" not in docs["r1"] and docs["r1"]["review_comment_message"] == "bom"
    assert docs["r3"]["review_comment_message"] == "" and docs["r3"]["review_creation_date"].startswith("2020-01-01")
    assert "review_answer_timestamp" not in docs["r2"]


def test_category_ids_are_dense_and_ordered(frame):
    names = ["artes", "arte", "bebes", "casa", "cama", "casa", None, "z"]
    out = documents.category_dimension(frame([(n, n) for n in names], "pt string, en string"), "pt", "en").collect()
    assert sorted((r[0], r[1]) for r in out) == list(enumerate(sorted(set(names) - {None}), start=1))


# -- layouts ---------------------------------------------------------------------------


def test_partition_layout_and_pruning(spark, frame, tmp_path):
    lo, hi = "2016-01-01", "2019-01-01"
    stamps = ["2015-12-31T23:59:59", "2016-01-01", "2017-06-15", "2017-07-01", "2018-12-31T23:59:59", "2019-01-01"]
    df = frame([(i, d(s)) for i, s in enumerate(stamps)] + [(99, None)], "id int, ts timestamp_ntz")
    path = str(tmp_path / "t")
    layout.write_partitioned(df, path, "ts", "month", lo, hi)
    counts = {r[0]: r[1] for r in quality.rows_per_partition(scans.read_partitioned(spark, path)).collect()}
    assert counts == {"default": 3, "2016_01": 1, "2017_06": 1, "2017_07": 1, "2018_12": 1}
    inside = scans.scan_range(spark, path, "ts", "2017-06-01", "2017-07-01", "month", lo, hi)
    assert [r["id"] for r in inside.collect()] == [2]
    assert len(inside.inputFiles()) >= 1
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2017_06" in plan.split("PartitionFilters:")[1]
    out = scans.scan_range(spark, path, "ts", "2015-01-01", "2016-02-01", "month", lo, hi)
    assert sorted(r["id"] for r in out.collect()) == [0, 1]


def test_sorted_copy_and_subset(spark, frame, tmp_path):
    df = frame([(i, d("2017-01-01") + dt.timedelta(hours=i % 50)) for i in range(500)], "id int, ts timestamp_ntz")
    layout.write_sorted(df, str(tmp_path / "s"), ["ts", "id"])
    got = scans.scan_sorted_range(spark, str(tmp_path / "s"), "ts", "2017-01-01", "2017-01-01 05:00:00")
    assert got.count() == 50
    layout.materialize_subset(df, F.col("id") < 10, ["id"], str(tmp_path / "u"))
    assert spark.read.parquet(str(tmp_path / "u")).count() == 10


def test_refresh_touches_only_its_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "m")
    layout.refresh_summary(frame([("2017_01", 1), ("2017_02", 2)], "m string, n int"), path, "m")
    layout.refresh_summary(frame([("2017_02", 5)], "m string, n int"), path, "m")
    assert {(r["m"], r["n"]) for r in spark.read.parquet(path).collect()} == {("2017_01", 1), ("2017_02", 5)}


def test_retention(frame):
    df = frame([(1, d("2018-01-31")), (2, d("2018-02-01")), (3, None)], "id int, ts timestamp_ntz")
    assert [r["id"] for r in layout.apply_retention(df, "ts", 6, "2018-08-01").collect()] == [2, 3]


def test_upsert(frame):
    base = frame([(1, "a", 10, d("2018-01-01")), (2, "b", 20, d("2018-01-01")), (3, "c", 30, d("2018-01-01"))], "id int, name string, n int, updated_at timestamp_ntz")
    ups = frame([(1, 11, 1), (1, 12, 2), (2, 20, 1), (4, 40, 1), (3, None, 1)], "id int, n int, v int")
    now = F.lit("2018-06-01").cast("timestamp_ntz")
    out = {r["id"]: r for r in upserts.upsert(base, ups, ["id"], ["v"], stamp=("updated_at", now)).drop("v").collect()}
    assert (out[1]["name"], out[1]["n"]) == ("a", 12) and out[4]["name"] is None
    assert out[3]["n"] is None
    assert str(out[4]["updated_at"]) == "2018-06-01 00:00:00"
    kept = {r["id"]: r["n"] for r in upserts.upsert(base, ups, ["id"], ["v"], keep_when_null=True).collect()}
    assert kept[3] == 30
    same = upserts.upsert(base, frame([(2, 20)], "id int, n int"), ["id"], ["n"], stamp=("updated_at", now))
    assert {r["id"]: str(r["updated_at"])[:7] for r in same.collect()} == {1: "2018-01", 2: "2018-01", 3: "2018-01"}


def test_insert_ignore(frame):
    base = frame([(1, "a")], "id int, v string")
    new = frame([(1, "z"), (2, "c"), (2, "b")], "id int, v string")
    assert sorted(map(tuple, upserts.insert_ignore(base, new, ["id"], ["v"]).collect())) == [(1, "a"), (2, "b")]


# -- change events ---------------------------------------------------------------------


def _event(i, agg, at, payload):
    return {"event_id": f"e{i}", "aggregate_type": "order", "aggregate_id": agg, "event_type": "OrderStatusChanged",
            "payload": payload, "created_at": at, "retries": 0}


def _write(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(e) for e in events))


def test_events_are_applied_once_in_any_order(spark, tmp_path):
    feed, root = tmp_path / "feed", str(tmp_path / "out")
    first = [_event(1, "o1", "2018-01-01T00:00:00Z", '{"status":"created"}'),
             _event(2, "o1", "2018-01-03T00:00:00Z", '{"status":"shipped"}'),
             _event(3, "o2", "2018-01-01T00:00:00Z", "{broken"),
             _event(4, None, "2018-01-01T00:00:00Z", '{"status":"x"}')]

    def run():
        stream = outbox.read_events(spark, str(feed), max_files=1)
        outbox.apply_events(stream, root, "status string", f"{root}/ck").awaitTermination()
        return {r["aggregate_id"]: r["status"] for r in outbox.current_documents(spark, root).collect()}

    _write(feed, "a.json", first)
    assert run() == {"o1": "shipped"}
    assert run() == {"o1": "shipped"}
    # an old event that comes late, a repeat of a handled one, and a new document
    _write(feed, "b.json", [_event(5, "o1", "2018-01-02T00:00:00Z", '{"status":"approved"}'), first[1],
                            _event(6, "o3", "2018-01-05T00:00:00Z", '{"status":"created"}')])
    assert run() == {"o1": "shipped", "o3": "created"}
    handled = {r[0] for r in outbox.processed_ids(spark, root).collect()}
    assert handled == {"e1", "e2", "e5", "e6"}
    bad = {(r["event_id"], r["retries"]) for r in outbox.rejected(spark, root).collect()}
    assert bad == {("e3", 1), ("e4", 1)}
    events = spark.read.schema(outbox.EVENTS).json(str(feed))
    left = [r["event_id"] for r in outbox.pending(events, outbox.processed_ids(spark, root)).collect()]
    assert sorted(left) == ["e3", "e4"]


def test_a_rerun_batch_changes_nothing(spark, frame, tmp_path):
    """The same batch handled twice leaves the same files' content."""
    root = str(tmp_path / "out")
    events = frame(
        [("e1", "order", "o1", "t", '{"status":"a"}', d("2018-01-01"), 0), ("e1", "order", "o1", "t", '{"status":"a"}', d("2018-01-01"), 0)],
        "event_id string, aggregate_type string, aggregate_id string, event_type string, payload string, created_at timestamp, retries int",
    )
    for _ in range(2):
        good, _bad = outbox.split_events(events, "status string")
        outbox.newest_changes(good).write.mode("overwrite").parquet(f"{root}/changes/batch_id=0")
    assert outbox.current_documents(spark, root).count() == 1


def test_partial_events_lose_no_field(spark, frame, tmp_path):
    """Each field has its newest value: events that leave it out, come late or repeat do not touch it."""
    feed, root = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()

    def run():
        stream = outbox.read_events(spark, str(feed), max_files=1)
        outbox.apply_events(stream, root, "status string, state string", f"{tmp_path}/ck").awaitTermination()
        return {r["aggregate_id"]: (r["status"], r["state"]) for r in outbox.current_documents(spark, root).collect()}

    _write(feed, "a.json", [_event(1, "o1", "2018-01-01T00:00:00Z", '{"status":"shipped"}'),
                            _event(2, "o1", "2018-01-02T00:00:00Z", '{"state":"RJ"}')])
    assert run() == {"o1": ("shipped", "RJ")}
    _write(feed, "b.json", [_event(3, "o1", "2018-01-01T12:00:00Z", '{"status":"approved","state":"SP"}'),
                            _event(2, "o1", "2018-01-02T00:00:00Z", '{"state":"RJ"}')])
    assert run() == {"o1": ("approved", "RJ")}
    _write(feed, "c.json", [_event(4, "o1", "2018-01-03T00:00:00Z", '{"state":null}')])
    assert run() == {"o1": ("approved", None)}
    base = frame([("o1", "created", "MG"), ("o2", "created", "RJ")], "order_id string, status string, state string")
    docs = outbox.current_documents(spark, root)
    folded = {r["order_id"]: (r["status"], r["state"]) for r in outbox.fold_into(base, docs, "order_id", "order").collect()}
    assert folded == {"o1": ("approved", None), "o2": ("created", "RJ")}
    assert outbox.fold_into(base, docs, "order_id", "product").drop("updated_at").collect() == base.collect()
    smaller = str(tmp_path / "compacted")
    outbox.compact(spark, root, smaller)
    assert outbox.current_documents(spark, smaller).collect() == docs.collect()
    assert outbox.processed_ids(spark, smaller).count() == 4 and spark.read.parquet(f"{smaller}/changes").count() == 1


def test_documents_fold_into_a_base(frame, spark):
    base = frame([("o1", "created", "SP"), ("o2", "created", "RJ")], "order_id string, status string, state string")
    changes = frame([("order", "o1", "shipped", d("2018-01-01")), ("order", "o9", "created", d("2018-01-01"))],
                    "aggregate_type string, aggregate_id string, status string, updated_at timestamp")
    out = {r["order_id"]: (r["status"], r["state"]) for r in outbox.fold_into(base, changes, "order_id", "order").collect()}
    assert out == {"o1": ("shipped", "SP"), "o2": ("created", "RJ"), "o9": ("created", None)}


def test_shared_folder_comes_from_the_session(spark):
    from storelens import session

    class Settings(dict):
        get = dict.get

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            applicationId = "app-1"
            getConf = staticmethod(dict)

        conf = Settings({"spark.checkpoint.dir": "hdfs:///shared/"})

    assert session.fresh_path(Cluster, "x").startswith("hdfs:///shared/storelens/x-")
    Cluster.conf = Settings()
    with pytest.raises(RuntimeError):
        session.shared_folder(Cluster)
    assert session.shared_folder(spark) == session.shared_folder(spark)


def test_null_keys_upsert_like_any_other(frame):
    from storelens.sinks.upserts import insert_ignore, upsert

    base = frame([(1, "a"), (None, "b")], "k int, v string")
    new = frame([(None, "c", 1), (2, "d", 1)], "k int, v string, at int")
    out = upsert(base, new, ["k"], ["at"])
    assert sorted((r["k"] or 0, r["v"]) for r in out.collect()) == [(0, "c"), (1, "a"), (2, "d")]
    again = upsert(out.drop("at"), new, ["k"], ["at"])
    assert again.count() == 3
    assert insert_ignore(base, frame([(None, "x"), (3, "y")], "k int, v string"), ["k"], ["v"]).count() == 3


def test_loading_replaces_documents_by_key(frame):
    base = frame([("r1", "old", 1), ("r2", "kept", 2)], "review_id string, note string, n int")
    docs = frame([("r1", "first", 1), ("r1", "second", 2), ("r3", "new", 1)], "review_id string, note string, n int")
    out = {r["review_id"]: r["note"] for r in documents.load(base, docs, "review_id", ["n"]).collect()}
    assert out == {"r1": "second", "r2": "kept", "r3": "new"}


def test_old_buckets_are_removed(spark, frame, tmp_path):
    from storelens.sinks import layout

    rows = frame([(1, d("2018-01-05")), (2, d("2018-03-05")), (3, d("2018-05-05"))], "k int, at timestamp_ntz")
    path = str(tmp_path / "t")
    layout.write_partitioned(rows, path, "at", "month", "2018-01-01", "2018-06-01")
    before = {p.name for p in (tmp_path / "t").glob("part=*")}
    gone = layout.delete_old_partitions(spark, path, 2, "2018-05-15")
    after = {p.name for p in (tmp_path / "t").glob("part=*")}
    assert len(gone) == 1 and before - after == {f"part={gone[0]}"}
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [2, 3]


def test_repeated_customers_do_not_multiply_orders(tables, frame):
    twice = {**tables, "customers": tables["customers"].union(tables["customers"])}
    assert documents.orders_analytics(twice).count() == documents.orders_analytics(tables).count()


def test_settings_grow_with_the_input():
    from storelens.session import settings_for

    assert settings_for(1)["spark.sql.shuffle.partitions"] == "200"
    assert int(settings_for(100 << 40)["spark.sql.shuffle.partitions"]) == 819200
