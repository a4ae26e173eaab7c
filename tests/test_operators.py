import random

import pytest
from pyspark.sql import functions as F

from storelens.operators import aggregates, joins, paging, quality, reshape


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_and_last_row_per_key(frame):
    df = frame(
        [(1, 5, "a"), (1, None, "b"), (1, 9, "c"), (1, 9, "d"), (2, 3, "e"), (None, 1, "f")],
        "k int, at int, v string",
    )
    assert {r[0]: r[2] for r in aggregates.last_row_per_key(df, ["k"], ["at"]).collect()} == {1: "d", 2: "e", None: "f"}
    assert {r[0]: r[2] for r in aggregates.first_row_per_key(df, ["k"], ["at"]).collect()} == {1: "b", 2: "e", None: "f"}


def test_last_row_keeps_map_columns(frame):
    df = frame([(1, 1, {"a": "x"}), (1, 2, {"b": "y"})], "k int, at int, m map<string,string>")
    assert aggregates.last_row_per_key(df, ["k"], ["at"]).first()["m"] == {"b": "y"}


def test_bucket_groups_use_the_default(frame):
    df = frame([(1,), (2,), (2,), (3,), (7,), (None,)], "s int")
    out = aggregates.bucket_groups(df, "s", [1, 2, 3], [F.count("*").alias("n")]).collect()
    assert [tuple(r) for r in out] == [("1", 1), ("2", 2), ("other", 3)]


def test_facet_from_a_written_input(frame, tmp_path):
    df = frame([("a", 3), ("b", 1), ("c", 2)], "k string, n int")
    branches = {
        "top": lambda g: paging.top_n(g, 2, F.col("n").desc()),
        "all": lambda g: g.agg(F.sum("n").alias("n")),
    }
    plain = {(r["facet"], r["k"], r["n"]) for r in aggregates.facet(df, branches).collect()}
    stored = {(r["facet"], r["k"], r["n"]) for r in aggregates.facet(df, branches, str(tmp_path / "g")).collect()}
    assert plain == stored == {("top", "a", 3), ("top", "c", 2), ("all", None, 6)}


def test_not_in_follows_sql_nulls(frame):
    left = frame([(1,), (2,), (None,)], "k int")
    ids = lambda values: frame([(v,) for v in values], "o int")
    run = lambda values: {r[0] for r in joins.not_in(left, ids(values), "k", "o").collect()}
    assert run([1]) == {2}
    assert run([1, None]) == set()
    assert run([]) == {1, 2, None}
    kept = {r[0] for r in joins.not_matched(left, ids([1, None]), "k", "o").collect()}
    assert kept == {2, None}


def test_not_in_needs_no_broadcast_of_the_other_side(spark, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = joins.not_in(frame([(1,)], "k int"), frame([(2,)], "o int"), "k", "o")
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_has_one_shape_at_every_size(frame):
    left = frame([("o1",), ("o2",), ("o3",)], "order_id string")
    hot = [("o1", i) for i in range(250)] + [("o1", 7)] * 500
    right = frame(hot + [("o2", 1), ("o2", 2), (None, 9)], "oid string, review int")
    for buckets in (1, 8):
        by_key = {}
        for r in joins.lookup(left, right, "order_id", "oid", "reviews", buckets=buckets).collect():
            by_key.setdefault(r["order_id"], {})[r["chunk"]] = [x["review"] for x in r["reviews"]]
        assert all(sorted(v) == list(range(buckets)) for v in by_key.values()) and len(by_key) == 3
        assert not any(by_key["o3"].values())
        assert sorted(x for v in by_key["o2"].values() for x in v) == [1, 2]
        assert sorted(x for v in by_key["o1"].values() for x in v) == sorted(i for _, i in hot)
    assert max(len(v) for v in by_key["o1"].values()) < 200


def test_lookup_unwound_repeats_rows(frame):
    left = frame([(1, 10.0), (2, 5.0)], "id int, v double")
    right = frame([(1, "a"), (1, "b")], "id int, r string")
    assert rows(joins.lookup_unwound(left, right, "id", "id").select("id", "v")) == [(1, 10.0), (1, 10.0), (2, 5.0)]


def test_translate_takes_the_last_duplicate(frame):
    words = frame([("casa", "home"), ("casa", "house")], "pt string, en string")
    df = frame([("casa",), ("x",), (None,)], "pt string")
    out = {r["pt"]: r["name"] for r in joins.translate(df, words, "pt", "en", "name", ["en"]).collect()}
    assert out == {"casa": "house", "x": None, None: None}


def test_denormalized_columns_of_one_name_all_stay(frame):
    orders = frame([(1, "a")], "order_id int, note string")
    out = joins.denormalize_orders(
        orders, frame([(1, "b")], "order_id int, note string"), frame([(1, "c", 2)], "order_id int, note string, value int"), frame([(1, 3)], "order_id int, value int")
    )
    assert out.first().asDict() == {"order_id": 1, "note": "a", "items_note": "b", "payments_note": "c", "value": 2, "reviews_value": 3}


def test_denormalized_rows_multiply(frame):
    orders = frame([(1,), (2,)], "order_id int")
    items = frame([(1, 1), (1, 2)], "order_id int, item int")
    pays = frame([(1, "x"), (1, "y")], "order_id int, pay string")
    revs = frame([(1, "r")], "order_id int, rev string")
    out = joins.denormalize_orders(orders, items, pays, revs)
    assert out.count() == 5 and out.filter("order_id = 2").first()["item"] is None


def test_paging_forms_agree(frame):
    df = frame([(i,) for i in range(100)], "k int")
    assert rows(paging.offset_page(df, "k", 50, 10)) == rows(paging.keyset_page(df, "k", 49, 10))
    assert rows(paging.keyset_page(df, "k", None, 3)) == [(0,), (1,), (2,)]


def test_null_orders(frame):
    df = frame([(1,), (None,), (2,)], "k int")
    assert [r[0] for r in df.orderBy(paging.newest_first("k")).collect()] == [None, 2, 1]
    assert [r[0] for r in df.orderBy(paging.oldest_first("k")).collect()] == [1, 2, None]


def test_unwind_and_pairs(frame):
    df = frame([(1, ["a", "b"]), (2, []), (3, None)], "id int, xs array<string>")
    assert rows(reshape.unwind(df, "xs", "x")) == [(1, "a"), (1, "b")]
    assert reshape.unwind(df, "xs", "x", keep_empty=True).count() == 4
    doc = frame([(1.0, None)], "w double, h double").select(
        reshape.pairs({"w": F.col("w"), "h": F.col("h")}).alias("a"),
        reshape.present_map({"w": F.col("w"), "h": F.col("h")}).alias("m"),
        reshape.as_document(["w", "h"]).alias("d"),
    ).first()
    assert [tuple(p) for p in doc["a"]] == [("w", 1.0), ("h", None)]
    assert doc["m"] == {"w": "1.0"} and doc["d"] == '{"w":1.0}'


# -- quality ---------------------------------------------------------------------------


def test_row_rules_find_planted_faults_and_pass_nulls(frame):
    df = frame(
        [(1, 3, "SP", "x"), (2, 9, "sp", " "), (3, None, None, None), (4, 0, "RJ", "y")],
        "id int, score int, state string, city string",
    )
    rules = [
        quality.in_range("score", 1, 5),
        quality.matches("state", "^[A-Z]{2}$"),
        quality.not_blank("city"),
        *quality.not_null("city"),
        quality.in_domain("state", ["SP", "RJ"]),
    ]
    found = {(r["check"], r["key"]) for r in quality.row_violations(df, "t", ["id"], rules).collect()}
    assert found == {
        ("range:score", "2"),
        ("range:score", "4"),
        ("pattern:state", "2"),
        ("domain:state", "2"),
        ("not_blank:city", "2"),
        ("not_null:city", "3"),
    }


def test_discount_range_is_open_below(frame):
    df = frame([(1, 0), (2, 100), (3, 101), (4, 5)], "id int, d int")
    out = quality.row_violations(df, "p", ["id"], [quality.in_range("d", 0, 100, lo_open=True)])
    assert sorted(r["key"] for r in out.collect()) == ["1", "3"]


def test_date_order_passes_nulls(frame):
    df = frame([(1, 5, 3), (2, 2, 3), (3, None, 3)], "id int, later int, earlier int")
    out = quality.row_violations(df, "o", ["id"], [quality.not_before("later", "earlier")])
    assert [r["key"] for r in out.collect()] == ["2"]


def test_keys(frame):
    child = frame([(1, 1), (1, 2), (9, 1), (9, 1), (None, 1)], "k int, n int")
    parent = frame([(1,), (2,)], "id int")
    fk = quality.foreign_key(child, "c", ["k"], parent, ["id"]).collect()
    assert [(r["key"], r["rows"]) for r in fk] == [("9", 2)]
    pk = quality.unique_key(child, "c", ["k", "n"]).collect()
    assert [(r["key"], r["rows"]) for r in pk] == [("9|1", 2)]


def test_overlaps_agree_with_brute_force(frame):
    rng = random.Random(3)
    import datetime as dt

    t0 = dt.datetime(2018, 1, 1)
    at = lambda h: None if h is None else t0 + dt.timedelta(hours=h)
    data = []
    for i in range(300):
        lo = rng.choice([None] + list(range(0, 400))) if rng.random() < 0.1 else rng.randrange(400)
        hi = None if rng.random() < 0.02 else (lo or 0) + rng.choice([0, 1, 5, 30])
        data.append((rng.randrange(40), at(lo), at(hi)))
    low, high = dt.datetime.min, dt.datetime.max
    live = [(k, a or low, b or high) for k, a, b in data if (a or low) < (b or high)]
    expected = set()
    for i, (k, a, b) in enumerate(live):
        for j, (k2, a2, b2) in enumerate(live):
            if i != j and k == k2 and a2 <= a < b2:
                expected.add((k, a))
    out = quality.overlapping_periods(
        frame(data, "k int, lo timestamp_ntz, hi timestamp_ntz"), "k", "lo", "hi"
    ).collect()
    got = {(r["k"], low if r["lo"].year == 1 else r["lo"]) for r in out}
    assert got == expected and len(out) == len(got)


def test_touching_periods_do_not_overlap(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ '2018-01-01', TIMESTAMP_NTZ '2018-02-01'), "
        "(1, TIMESTAMP_NTZ '2018-02-01', TIMESTAMP_NTZ '2018-03-01') AS t(k, lo, hi)"
    )
    assert quality.overlapping_periods(df, "k", "lo", "hi").count() == 0


def test_dependencies_and_cardinality(frame):
    df = frame([(1, "a", 10), (1, "a", 20), (2, "b", 10), (2, None, 10)], "k int, v string, w int")
    assert [(r["k"], r["versions"]) for r in quality.determines(df, ["k"], ["v"]).collect()] == [(2, 2)]
    assert {r["k"] for r in quality.determines(df, ["k"], ["w"]).collect()} == {1}
    one = frame([(1,), (2,), (None,), (None,)], "k int")
    assert tuple(quality.cardinality(one, df, "k").first()) == ("1", "N")


def test_duplicates_and_granularity(frame):
    df = frame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None)], "k int, v string")
    assert quality.duplicate_rows(df).first()[0] == 3
    assert tuple(quality.granularity(df, "k").first()) == (5, 2, 2)
    assert [tuple(r) for r in quality.repeated_keys(df, "k", 1).collect()] == [(1, 3)]
    assert quality.duplicate_rows(df.limit(0)).first()[0] == 0


def test_integrity_rate(frame):
    child = frame([(1,), (1,), (7,), (None,)], "k int")
    parent = frame([(1,), (1,)], "id int")
    assert tuple(quality.integrity_error_rate(child, "k", parent, "id").first()) == (4, 1, 0.25)


@pytest.mark.parametrize(
    ("doc", "broken"),
    [
        ('{"zip_code_prefix":1,"city":"x","state":"SP","location":{"type":"Point","coordinates":[1,2]},"more":1}', set()),
        ('{"zip_code_prefix":1,"city":"x","location":{"type":"Line","coordinates":[1]}}',
         {"required:state", "enum:location.type", "min_items:location.coordinates"}),
        ('{"zip_code_prefix":true,"city":null,"state":"SP","location":{"type":"Point"}}',
         {"type:zip_code_prefix", "type:city", "required:location.coordinates"}),
        ('{"zip_code_prefix":1,"city":"x","state":"SP","location":7}', {"type:location"}),
        ("{broken", {"type:document"}),
        ("[1]", {"type:document"}),
    ],
)
def test_document_shape(frame, doc, broken):
    from storelens.schemas import GEOLOCATION_POINTS_DOC

    df = frame([(1, doc)], "id int, body string").withColumn("doc", F.try_parse_json("body"))
    out = quality.validate_docs(df, "doc", "id", GEOLOCATION_POINTS_DOC, "g").collect()
    assert {r["check"] for r in out} == broken


def test_array_items_are_checked(frame):
    from storelens.schemas import SELLER_STATE_BUCKETS_DOC

    docs = [
        (1, '{"state":"SP","seller_count":1,"sellers":[{"seller_id":"a","city":"x"}]}'),
        (2, '{"state":"SP","seller_count":1,"sellers":[{"seller_id":"a","city":"x"},{"seller_id":5}]}'),
    ]
    df = frame(docs, "id int, body string").withColumn("doc", F.parse_json("body"))
    out = quality.validate_docs(df, "doc", "id", SELLER_STATE_BUCKETS_DOC, "b").collect()
    assert {(r["key"], r["check"]) for r in out} == {
        ("2", "required:sellers[].city"),
        ("2", "type:sellers[].seller_id"),
    }
