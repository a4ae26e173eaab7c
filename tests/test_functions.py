import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from storelens.functions import geo, predicates, scalars, text
from storelens.plans import reports
from storelens.sources import readers


def test_half_even_and_improvement(value):
    assert float(value(scalars.half_even(F.lit(2.345).cast("decimal(10,3)"), 2))) == 2.34
    assert value(scalars.improvement_percent(F.lit(46), F.lit(133))) == -189.13
    assert value(scalars.improvement_percent(F.lit(0), F.lit(5))) is None
    assert value(scalars.improvement_percent(F.lit(None).cast("int"), F.lit(5))) is None


@pytest.mark.parametrize("n", [1, 3, 16, 1000, 2**31])
def test_hash_bucket_is_the_big_integer_modulo(value, n):
    for key in ("a", "order-17", "São"):
        expected = int(hashlib.sha256(key.encode()).hexdigest(), 16) % n
        assert value(scalars.hash_bucket(F.lit(key), n)) == expected


@pytest.mark.parametrize(
    "raw", ["2x-ab", "cama_mesa banho", "pcs", "", "a1b2", "o'neill", "ÁGUA d'or"]
)
def test_title_case_is_pythons(value, raw):
    assert value(scalars.title_case(F.lit(raw))) == raw.title()


def test_volumes_differ_on_missing_sides(value):
    none = F.lit(None).cast("double")
    assert value(scalars.volume_or_zero(F.lit(2.0), none, F.lit(3.0))) == 0
    assert value(scalars.volume_or_null(F.lit(2.0), none, F.lit(3.0))) is None


def test_narrow_and_weight_class(value):
    assert value(F.to_json(F.struct(scalars.narrow(F.lit(225.0)).alias("a")))) == '{"a":225}'
    assert value(F.to_json(F.struct(scalars.narrow(F.lit(2.5)).alias("a")))) == '{"a":2.5}'
    classes = [value(scalars.weight_class(F.lit(g).cast("double"))) for g in (1001, 1000, 301, 300)]
    assert classes == ["heavy", "medium", "medium", "light"]
    assert value(scalars.weight_class(F.lit(None).cast("double"))) == "light"


def test_event_key_separates_parts(value):
    a = value(scalars.event_key(F.lit("ab"), F.lit("c")))
    b = value(scalars.event_key(F.lit("a"), F.lit("bc")))
    assert a != b


def test_exact_mean_rounds_once(value):
    mean = scalars.exact_mean(F.lit("0.0449995").cast("decimal(20,7)"), F.lit(1), 2)
    assert float(value(mean)) == 0.04


@pytest.mark.parametrize(
    ("haystack", "needle", "found"),
    [
        ("São Paulo", "sao paulo", True),
        ("SAO PAULO", "são", True),
        ("san pablo", "sao", False),
        ("Brasília", "BRASILIA", True),
        ("100% ok", "0% o", True),
    ],
)
def test_folded_contains(value, haystack, needle, found):
    assert value(predicates.folded_contains(F.lit(haystack), needle)) is found


def test_folded_like_takes_wildcards(value):
    like = lambda t, p: value(predicates.folded_like(F.lit(t), p))
    assert like("São Paulo", "s_o%lo")
    assert not like("São Paulo", "s_o")
    assert like("50%", "50\\%")


@pytest.mark.parametrize(
    ("doc", "wanted", "found"),
    [
        ('{"a":{"b":1,"c":2}}', {"a": {"b": 1}}, True),
        ('{"a":{"b":1.0}}', {"a": {"b": 1}}, True),
        ('{"a":{"b":"1"}}', {"a": {"b": 1}}, False),
        ('{"a":{"b":1}}', {"a": {"b": "1"}}, False),
        ('{"t":["x","y","z"]}', {"t": ["z", "x"]}, True),
        ('{"t":["x"]}', {"t": ["x", "q"]}, False),
        ('{"t":[{"k":1,"j":2},{"k":3}]}', {"t": [{"k": 3}]}, True),
        ('{"n":null}', {"n": None}, True),
        ('{"m":1}', {"n": None}, False),
        ('{"g":true}', {"g": True}, True),
        ('{"g":"true"}', {"g": True}, False),
        ("{broken", {"a": 1}, False),
        (None, {"a": 1}, False),
        ('{"a":1}', {}, True),
    ],
)
def test_json_contains(value, doc, wanted, found):
    assert value(predicates.json_contains(F.lit(doc).cast("string"), wanted)) is found


def test_period_is_half_open_and_open_ended(value):
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    live = lambda lo, hi: value(predicates.active_at(ts(lo), ts(hi), "2018-05-01"))
    assert live("2018-05-01", "2018-05-02")
    assert not live("2018-04-01", "2018-05-01")
    assert live(None, "2018-06-01") and live("2018-01-01", None) and live(None, None)


def test_day_range_keeps_the_filter_pushable(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = df.filter(predicates.day_range(F.col("o_orderdate"), "1997-06-10"))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in shown and "LessThan(o_orderdate" in shown


def py_grams(s):
    import re

    out = set()
    for w in re.findall(r"[^\W_]+", s.lower()):
        p = f"  {w} "
        out |= {p[i : i + 3] for i in range(len(w) + 1)}
    return out


def py_sim(a, b):
    a, b = py_grams(a), py_grams(b)
    return len(a & b) / len(a | b) if a | b else 0.0


@pytest.mark.parametrize(
    ("a", "b"),
    [("word", "two words"), ("computers_accessories", "computer accesories"), ("", "x"), ("!!", ""), ("aaaa", "aaa")],
)
def test_similarity(value, a, b):
    assert value(text.similarity(F.lit(a), F.lit(b))) == pytest.approx(py_sim(a, b))


def test_fuzzy_search(frame):
    df = frame([("computers_accessories",), ("perfumery",), (None,)], "name string")
    rows = text.fuzzy_search(df, "name", "computer accesories").collect()
    assert [r["name"] for r in rows] == ["computers_accessories"]
    assert rows[0]["score"] == pytest.approx(py_sim("computers_accessories", "computer accesories"))


@pytest.mark.parametrize("threshold", [0.2, 0.3, 0.55, 1.0])
@pytest.mark.parametrize("block", [2, 1000])
def test_fuzzy_join_finds_all_pairs(frame, threshold, block):
    import random

    rng = random.Random(7)
    stems = ["casa", "cama", "mesa", "banho", "beleza", "saude", "esporte"]
    make = lambda: " ".join(rng.choice(stems) + rng.choice(["", "s", "r"]) for _ in range(rng.randint(1, 3)))
    left = [make() for _ in range(40)] + ["casa mesa"] * 60 + [None, ""]
    right = [make() for _ in range(40)] + ["casa mesa"] * 30 + [None, "!"]
    got = text.fuzzy_join(
        frame([(v,) for v in left], "v string"),
        frame([(v,) for v in right], "v string"),
        "v",
        "v",
        threshold,
        gram_block=block,
    ).collect()
    expected = {
        (a, b): py_sim(a, b)
        for a in set(left) - {None}
        for b in set(right) - {None}
        if py_sim(a, b) >= threshold
    }
    assert len(got) == len(expected)
    assert {(r[0], r[1]): pytest.approx(r[2]) for r in got} == expected


def test_fuzzy_join_over_several_blocks_sends_no_table_to_the_driver(frame):
    left = [f"casa {i} mesa" for i in range(1100)] + ["!", None]
    right = [f"casa {i}" for i in range(0, 1100, 50)] + left[:3]
    joined = text.fuzzy_join(frame([(v,) for v in left], "v string"), frame([(v,) for v in right], "v string"), "v", "v", 0.75)
    assert "Broadcast" not in joined._jdf.queryExecution().toString()
    expected = {(a, b): py_sim(a, b) for a in left if a for b in right if py_sim(a, b) >= 0.75}
    assert {(r[0], r[1]): pytest.approx(r[2]) for r in joined.collect()} == expected and joined.count() == len(expected)


def test_fuzzy_join_stores_values_and_no_pairs(frame, monkeypatch):
    kept = []
    monkeypatch.setattr(text, "_kept", lambda df, label, write=text._kept: kept.append(write(df, label)) or kept[-1])
    left = [f"casa {i} mesa" for i in range(150)]
    right = [f"casa {i} mesa" for i in range(100, 200)]
    joined = text.fuzzy_join(frame([(v,) for v in left], "v string"), frame([(v,) for v in right], "v string"), "v", "v", 0.3, gram_block=40)
    expected = {(a, b): py_sim(a, b) for a in left for b in right if py_sim(a, b) >= 0.3}
    assert {(r[0], r[1]): pytest.approx(r[2]) for r in joined.collect()} == expected and joined.count() == len(expected) == 15_000
    assert sum(df.count() for df in kept) <= 200
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert -1 < plan.find("CartesianProduct") < plan.find("Exchange")


@pytest.mark.parametrize("threshold", [0.1, 0.45, 1.0])
@pytest.mark.parametrize("vocabulary", [12, 60, 3000])
def test_blocks_of_sets_give_all_near_pairs(threshold, vocabulary):
    rng = np.random.default_rng(5)
    draw = lambda n: [sorted({*rng.integers(0, vocabulary, rng.integers(1, 12)).tolist(), *([7, 8] if rng.random() < 0.5 else [])}) for _ in range(n)]
    sides = draw(90), draw(70) + [[10**15], list(range(vocabulary))]
    blocks = [text._block(pa.table({"value": [str(i) for i in range(len(s))], "grams": pa.array(s, pa.list_(pa.int64()))})) for s in sides]
    l, r = ([np.frombuffer(b[c][0].as_buffer(), kind) for c, kind in text._ARRAYS] for b in blocks)
    got = {(int(i), int(j)): s for part in text._near(l, r, threshold) for i, j, s in zip(*part, strict=True)}
    scores = {(i, j): len({*a} & {*b}) / len({*a} | {*b}) for i, a in enumerate(sides[0]) for j, b in enumerate(sides[1])}
    assert got == {k: v for k, v in scores.items() if v >= threshold}


@pytest.mark.parametrize("share", [0.03, 0.3])
def test_shared_grams_are_counted_in_several_steps(share):
    l, r = (np.random.default_rng(seed).random((900, 2600)) < share for seed in (1, 2))
    l[:, 7], r[:, 7] = True, True
    sides = [(np.nonzero(m.T)[1], np.nonzero(m.T)[0], len(m)) for m in (l, r)]
    assert (text._shared(*sides, 2600) == l.astype(np.float32) @ r.T.astype(np.float32)).all()


def test_sets_are_packed_whole_and_in_order():
    sets = [[i, i + 1] for i in range(25)] + [list(range(text.BLOCK_GRAMS + 1))] + [[i] for i in range(6)]
    table = pa.table({"value": [str(i) for i in range(len(sets))], "grams": pa.array(sets, pa.list_(pa.int64()))})
    blocks = [*text._packed(10)(iter(table.to_batches(max_chunksize=7)))]
    assert [v for b in blocks for v in b["values"][0].as_py()] == [str(i) for i in range(len(sets))]
    assert [len(b["values"][0]) for b in blocks] == [10, 10, 5, 1, 6]
    assert [(b["least"][0].as_py(), b["most"][0].as_py()) for b in blocks[2:]] == [(2, 2), (text.BLOCK_GRAMS + 1,) * 2, (1, 1)]


def test_keyword_search_scores_and_stop_words(frame):
    df = frame(
        [(1, "Muito bom produto", "bom bom"), (2, "ruim", None), (3, None, "bomba"), (4, "", "")],
        "id int, title string, message string",
    )
    rows = {r["id"]: r["score"] for r in text.keyword_search(df, ["title", "message"], "o BOM").collect()}
    assert rows == {1: pytest.approx(3 * (math.log(5 / 2) + 1))}
    assert text.keyword_search(df, ["title"], "de o").count() == 0


def test_distances(value):
    m = lambda *p: value(geo.geodesic_m(*[F.lit(float(x)) for x in p]))
    assert m(0, 0, 0, 1) == pytest.approx(111319.491, abs=0.001)
    assert m(0, 0, 1, 0) == pytest.approx(110574.389, abs=0.001)
    assert m(-23.55, -46.63, -23.55, -46.63) == 0
    # Flinders Peak - Buninyong on WGS84
    assert m(-37.95103341666667, 144.42486788888888, -37.65282113888889, 143.92649552777777) == pytest.approx(54972.271, abs=0.01)
    # far points settle late; opposite ones are solved by their azimuth
    assert m(0, 0, 0.5, 179.5) == pytest.approx(19936288.579, abs=0.01)
    assert m(0, 0, 0.5, 179.5) == pytest.approx(19936288.578965, abs=0.001)
    assert m(0, 0, 0.5, 179.7) == pytest.approx(19944127.4208, abs=0.001)
    # a quarter turn to the pole and on: half a meridian, whichever way it is named
    assert m(0, 0, 0, 180) == pytest.approx(20003931.4586, abs=0.001) and m(90, 7, -90, 7) == pytest.approx(20003931.4586, abs=0.001)
    assert m(0, 0, 0.1, 179.9) < m(0, 0, 0, 180) and m(10, 20, -10, 200) == pytest.approx(20003931.4586, abs=0.001)
    sphere = value(geo.sphere_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    assert sphere == pytest.approx(m(0, 0, 0, 1), rel=0.005)


def test_distances_of_many_pairs_run_over_batches(frame):
    import random

    rng = random.Random(3)
    place = lambda: (rng.uniform(-90, 90), rng.uniform(-180, 180))
    rows = [(*place(), *place()) for _ in range(300)]
    rows += [(0.0, 0.0, 0.0, 180.0), (0.0, 0.0, 0.5, 179.7), (90.0, 0.0, -90.0, 5.0), (1.0, 2.0, 1.0, 2.0), (0.0, 1.0, 0.0, 2.0), (None, 1.0, 2.0, 3.0), (1.0, 1.0, 2.0, None)]
    at = [F.col(c) for c in "abcd"]
    out = frame(rows, "a double, b double, c double, d double").select(geo.geodesic_m(*at).alias("one"), geo.geodesic_pairs_m(*at).alias("many"))
    assert all(r.many == (None if r.one is None else pytest.approx(r.one, abs=1e-5)) for r in out.collect())
    pairs = frame([(1, 2), (2, 1), (1, 9)], "seller_zip int, customer_zip int")
    found = reports.pair_distances(pairs, frame([(1, 0.0, 0.0), (2, 0.0, 1.0)], "zip_code_prefix int, latitude double, longitude double"))
    assert "ArrowEvalPython" in found._jdf.queryExecution().toString()
    assert sorted((r[0], r[1], round(r[2], 3)) for r in found.collect()) == [(1, 2, 111.319), (2, 1, 111.319)]


def test_nearest_each_agrees_with_all_pairs(frame):
    import random

    draw = random.Random(3)
    spots = [(i, draw.uniform(-89.9, 89.9), draw.uniform(-180, 180)) for i in range(150)]
    spots += [(150 + i, draw.uniform(-1, 1), draw.uniform(179, 181) - (360 if i % 2 else 0)) for i in range(20)]
    spots = [(i, lat, (lng + 180) % 360 - 180) for i, lat, lng in spots] + [(900, None, 1.0)]
    asked = [(i, lat, lng) for i, lat, lng in spots[:170:6]] + [(500, 89.99, 0.0), (501, -90.0, 10.0), (502, 0.0, 180.0), (503, None, 0.0)]

    def away(a, b):
        p, q = math.radians(a[1]), math.radians(b[1])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return round(2 * geo.SPHERE_RADIUS * math.asin(math.sqrt(min(h, 1))), 3)

    out = geo.nearest_each(
        frame(spots, "k int, lat double, lng double"), frame(asked, "q int, qlat double, qlng double"), "lat", "lng", "qlat", "qlng", "q", 4, ["k"]
    ).collect()
    got = {q: [r["k"] for r in sorted(out, key=lambda r: r["place"]) if r["q"] == q] for q, _, _ in asked}
    real = [s for s in spots if s[1] is not None]
    for q in asked:
        want = [] if q[1] is None else [s[0] for s in sorted(real, key=lambda s: (away(s, q), s[0]))[:4]]
        assert got[q[0]] == want


def test_nearest_breaks_ties_by_key(frame):
    df = frame([(2, 0.0, 1.0), (1, 0.0, -1.0), (3, 0.0, 5.0), (4, None, 1.0)], "k int, lat double, lng double")
    rows = geo.nearest(df, "lat", "lng", 0.0, 0.0, 2, ["k"]).collect()
    assert sorted(r["k"] for r in rows) == [1, 2]


def test_text_forms(value):
    arr = lambda s: value(readers.parse_array_text(F.lit(s).cast("string")))
    assert arr("{a,b}") == ["a", "b"]
    assert arr('{"x, y",z}') == ["x, y", "z"]
    assert arr("{}") == [] and arr(None) is None and arr("{NULL}") == [None]
    rng = lambda s: value(readers.parse_range_text(F.lit(s)))
    got = rng('["2018-01-01T00:00:00+00:00","2018-02-01T00:00:00+00:00")')
    assert (str(got["lo"]), str(got["hi"])) == ("2018-01-01 00:00:00", "2018-02-01 00:00:00")
    assert rng('[,"2018-02-01T00:00:00+00:00")')["lo"] is None
    assert got["valid"] and rng('[,"2018-02-01T00:00:00+00:00")')["valid"]
    # no range: nothing is in it, and it says why
    assert [(rng(x)["lo"] == rng(x)["hi"], rng(x)["valid"]) for x in ("empty", "garbage", "", '["x","2018-02-01")')] == [
        (True, True), (True, False), (True, False), (True, False)
    ]
    both = rng("(2018-01-01,2018-02-01]")
    assert (str(both["lo"]), str(both["hi"])) == ("2018-01-01 00:00:00.000001", "2018-02-01 00:00:00.000001")
    assert arr(r'{"a\"b","c\\d",e\,f,"NULL"}') == ['a"b', "c\\d", "e,f", "NULL"]
    assert arr("{a,}") == ["a", ""]


def test_csv_with_line_breaks_and_typed_columns(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        'review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp\n'
        'a,o1,4,,"two\nlines, ""quoted""",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        "b,o2,5,,,2018-03-10 00:00:00,\n"
    )
    from storelens.schemas import ORDER_REVIEWS

    rows = readers.read_csv(spark, str(tmp_path), ORDER_REVIEWS, multiline=True).orderBy("review_id").collect()
    assert rows[0]["review_comment_message"] == 'two\nlines, "quoted"'
    assert rows[1]["review_comment_message"] is None and rows[1]["review_answer_timestamp"] is None
    assert rows[0]["review_score"] == 4


def test_rows_that_do_not_fit_are_told(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "r.csv").write_text("id,price,at\n1,2.50,2018-01-01 00:00:00\n2,x,2018-01-01 00:00:00\n3,1.00\n4,1.00,never\n")
    schema = "id int, price decimal(12,2), at timestamp"
    good, bad = readers.read_csv_with_rejects(spark, str(tmp_path / "c"), schema)
    assert [r["id"] for r in good.collect()] == [1]
    assert sorted(r["_corrupt_record"][0] for r in bad.collect()) == ["2", "3", "4"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_csv(spark, str(tmp_path / "c"), schema).collect()
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "d.json").write_text('{"id":1}\nnot json\n{"id":"x"}\n')
    good, bad = readers.read_docs_with_rejects(spark, str(tmp_path / "j"), "id int")
    assert [r["id"] for r in good.collect()] == [1] and bad.count() == 2
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_docs(spark, str(tmp_path / "j"), "id int").collect()


def test_large_integers_are_told_apart(value):
    big = 9007199254740993
    assert value(predicates.json_contains(F.lit(f'{{"a":{big}}}'), {"a": big}))
    assert not value(predicates.json_contains(F.lit(f'{{"a":{big}}}'), {"a": big - 1}))


def test_defaults(frame):
    df = frame([(1, None), (2, "x")], "id int, tag string")
    rows = readers.with_defaults(df, {"tag": F.lit("none"), "retries": F.lit(0)}).orderBy("id").collect()
    assert [(r["tag"], r["retries"]) for r in rows] == [("none", 0), ("x", 0)]


def test_open_documents_and_column_types(spark, frame, tmp_path):
    from storelens.operators.aggregates import column_types

    (tmp_path / "d.json").write_text('{"a":1}\nnot json\n{"b":{"c":[1,2]}}\n')
    docs = readers.read_open_docs(spark, str(tmp_path))
    got = {r[0] for r in docs.select(F.to_json("doc")).collect()}
    assert got == {'{"a":1}', None, '{"b":{"c":[1,2]}}'}
    assert column_types(frame([(1, "x")], "id int, v string")) == [("id", "int"), ("v", "string")]


def test_product_headers_are_renamed(frame):
    df = frame([(1.0, 2.0)], "product_name_lenght double, product_description_lenght double")
    assert readers.rename_product_lengths(df).columns == ["product_name_length", "product_description_length"]
