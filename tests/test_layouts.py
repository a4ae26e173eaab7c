"""What a reader opens: the keyword index, JSON paths as columns, copies by id; and Portuguese stems."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from storelens.functions import predicates, text
from storelens.functions.stemming import portuguese_stem
from storelens.operators import search
from storelens.sinks import layout
from storelens.sources import json_paths, scans


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    "words",
    [
        "boa boa boas boas boate boat boates boat boatos boat boba bob bobagem bobag bobalhões bobalhõ bobear bob bobeira bobeir bobinho bobinh",
        "boca boc bocadas boc bocadinho bocadinh bocado boc bocarra bocarr bode bod body body boi boi boiando boi bogotá bogot boêmio boêmi",
        "quilométricas quilométr quilométricos quilométr quilômetro quilômetr química químic quimicamente quimic",
        "nação naçã nações naçõ rapidamente rapid a a os os xyz xyz",
    ],
)
def test_stems(words):
    pairs = words.split()
    for word, stem in zip(pairs[::2], pairs[1::2], strict=True):
        assert portuguese_stem(word) == stem, word


DOCS = [(1, "Produto bom, muito bom"), (2, "produtos bons"), (3, None), (4, ""), (5, "Entrega rápida; produto"), (6, "outra coisa")] + [(10 + i, "comum") for i in range(40)]


def test_index_scores_as_the_scan(spark, tmp_path):
    docs = spark.createDataFrame([(k, v, "loja") for k, v in DOCS], "id long, body string, shop string")
    search.build_index(docs, "id", ["body", "shop"], str(tmp_path / "plain"))
    for query in ("produto bom", "comum loja rápida", "nada", "de o a", "Bom BOM"):
        want = {r.id: r.score for r in text.keyword_search(docs, ["body", "shop"], query).collect()}
        got = {r.key: r.score for r in search.search(spark, str(tmp_path / "plain"), query).collect()}
        assert got == pytest.approx(want), query


def test_stemmed_index_finds_other_forms(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "id long, body string")
    path = str(tmp_path / "stems")
    search.build_index(docs, "id", ["body"], path, stems=True)
    got = {r.key: r.score for r in search.search(spark, path, "produtos boas").collect()}
    tf = {k: Counter(portuguese_stem(w) for w in re.findall(r"[^\W_]+", (v or "").lower())) for k, v in DOCS}
    want = Counter()
    for term in (portuguese_stem("produtos"), portuguese_stem("boas")):
        rarity = math.log((len(DOCS) + 1) / (sum(term in c for c in tf.values()) + 1)) + 1
        want.update({k: c[term] * rarity for k, c in tf.items() if c[term]})
    assert {1, 2, 5} <= set(got) and got == pytest.approx(dict(want))
    # only the folders of the query's terms are opened, and the terms reach the scan
    read = search._of(search.postings(spark, path), ["produt"])
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ (IN|=|INSET) ", plan(read))
    assert "PushedFilters: [In(term" in plan(read) or "EqualTo(term" in plan(read)


def test_json_paths(spark, tmp_path):
    texts = ['{"a":{"b":"x","n":3},"k":true}', '{"a":{"b":5},"k":"true"}', '{"a":{"b":"x"}}', "{broken", None, '{"a":["b"],"k":false}', '{"a":{"n":3.0}}', '{"a":{"n":"3"}}']
    df = spark.createDataFrame(list(enumerate(texts)), "id long, doc string")
    spec = json_paths.JsonPaths("doc", {"a.b": "string", "a.n": "double", "k": "boolean"})
    path = str(tmp_path / "json")
    json_paths.with_paths(df, spec).write.parquet(path)
    table = spark.read.parquet(path)
    for wanted in ({"a": {"b": "x"}}, {"a": {"b": "5"}}, {"a": {"n": 3}}, {"k": True}, {"k": "true"}, {"a": {"b": "x", "n": 3}, "k": True}, {"a": {}}, {}, {"a": ["b"]}, {"a": {"b": "x"}, "z": 1}):
        got = sorted(r.id for r in table.filter(json_paths.holds(spec, wanted)).collect())
        assert got == sorted(r.id for r in df.filter(predicates.json_contains(F.col("doc"), wanted)).collect()), wanted
    # all declared: pushed down, and the text is not even read
    found = table.filter(json_paths.holds(spec, {"a": {"b": "x", "n": 3}})).select("id")
    assert "EqualTo(doc__a__b,x)" in plan(found) and "EqualTo(doc__a__n,3.0)" in plan(found)
    assert "ReadSchema: struct<id:bigint,doc__a__b:string,doc__a__n:double>" in plan(found)
    assert "EqualTo(doc__a__b,x)" in plan(table.filter(json_paths.holds(spec, {"a": {"b": "x"}, "z": 1})))


def test_lookups_by_id_open_one_folder(spark, tmp_path):
    path = str(tmp_path / "ids")
    df = spark.createDataFrame([(i, f"s{i}") for i in range(500)] + [(None, "none")], "id long, status string")
    layout.write_by_id(df, path, "id", 16)
    read = lambda i: scans.read_by_id(spark, path, "id long, status string", "id", i, 16)
    assert [r.status for r in read(77).collect()] == ["s77"] and read(9999).count() == 0
    # the bucket is worked out before the scan
    assert re.search(r"PartitionFilters: \[isnotnull\(id_bucket#\d+\), \(id_bucket#\d+ = \d+\)\]", plan(read(77)))
    assert "EqualTo(id,77)" in plan(read(77))
    assert spark.read.parquet(path).count() == 501


def test_sorted_copies_have_as_many_ranges_as_rows_ask_for(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("k"))
    layout.write_sorted(df, str(tmp_path / "many"), ["k", "id"], rows_per_range=50)
    files = spark.read.parquet(str(tmp_path / "many")).select(F.input_file_name().alias("f"), "k", "id").groupBy("f").agg(F.min(F.struct("k", "id")).alias("lo"), F.max(F.struct("k", "id")).alias("hi"))
    edges = sorted((r.lo, r.hi) for r in files.collect())
    assert len(edges) >= 15 and all(a[1] < b[0] for a, b in zip(edges, edges[1:]))
