"""Ordered work over ranges: numbering, overlaps on one busy key, and joins that spread it."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from storelens.functions import geo
from storelens.operators import quality
from storelens import session
from storelens.operators.runs import RUN, numbered, sorted_runs, spread_join


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables would be merged into one range."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_a_busy_key_lies_in_several_ranges(spark):
    rows = [("hot", i) for i in range(4000)] + [(f"k{i}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(7)
    runs = sorted_runs(df, ["k", "v"])
    sizes = {r[RUN]: r.n for r in runs.groupBy(RUN).agg(F.count("*").alias("n")).collect()}
    assert len(sizes) > 1 and max(sizes.values()) < 0.6 * len(rows)
    # ranges follow the order
    edges = runs.groupBy(RUN).agg(F.min(F.struct("k", "v")).alias("lo"), F.max(F.struct("k", "v")).alias("hi")).orderBy(RUN).collect()
    assert all(a.hi < b.lo for a, b in zip(edges, edges[1:]))


def test_numbers(spark):
    names = [f"prefix {i:05d}" for i in range(3000)] + [None]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n, "x") for n in names], "name string, _n string").repartition(5)
    got = {r.name: r.place for r in numbered(df, ["name"], "place").collect()}
    assert got == {n: i for i, n in enumerate([None, *sorted(n for n in names if n)], 1)}
    assert numbered(df.limit(0), ["name"], "place").count() == 0


def test_overlaps_on_one_key_and_day(spark):
    rnd, day = random.Random(2), dt.datetime(2020, 1, 1)
    rows = []
    for _ in range(3000):
        lo = day + dt.timedelta(seconds=rnd.randrange(86_400))
        rows.append((7, lo, lo + dt.timedelta(seconds=rnd.choice([0, 1, 5, 20]))))
    rows += [(8, None, day), (8, day - dt.timedelta(days=1), None), (8, day, day), (None, day, None)]
    got = {(r.k, r.lo): (r.periods, r.open_until) for r in quality.overlapping_periods(spark.createDataFrame(rows, "k long, lo timestamp, hi timestamp").repartition(6), "k", "lo", "hi").collect()}
    low, high, want = dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31, 23, 59, 59), {}
    for key in (7, 8):
        held = sorted((lo or low, hi or high) for k, lo, hi in rows if k == key)
        held = [p for p in held if p[0] < p[1]]
        for start in {lo for lo, _ in held}:
            periods, before = sum(lo == start for lo, _ in held), [hi for lo, hi in held if lo < start]
            if periods > 1 or (before and max(before) > start):
                want[(key, start)] = (periods, max(before, default=None))
    assert got == want and len(want) > 100


def test_spread_join(spark):
    many = spark.createDataFrame([("a", i % 9, i) for i in range(90)] + [("b", 0, 1), ("c", 0, 2)], "k string, salt int, v long")
    one = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, x double")
    got = sorted(tuple(r) for r in spread_join(many, one, ["k"], "salt").collect())
    assert got == sorted([("a", i % 9, i, 1.0) for i in range(90)] + [("b", 0, 1, 2.0), ("c", 0, 2, None)], key=lambda r: r[:3])


def test_tasks_grow_in_number_and_not_in_size(spark, tmp_path):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.sources.fileCompressionFactor"]
    before, first = [spark.conf.get(k) for k in keys], "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        session.fit_tasks(spark, 6 << 30)
        assert spark.conf.get(first) == "3072"
        advised = spark.conf.get(keys[1])
        with session.file_sized(spark):
            assert spark.conf.get(keys[1]) == "64m"
        assert spark.conf.get(keys[1]) == advised
        session.fit_tasks(spark, 1)
        assert spark.conf.get(first, None) is None
        # 80 MB in a shuffle are merged to tasks of a few MB, not to one for each core
        rows = spark.range(10_000_000).select("id", F.xxhash64("id").alias("x")).groupBy(F.col("id") % 5_000_000, "x").agg(F.count("*").alias("n"))
        session.fit_tasks(spark, 1 << 30)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        rows.write.parquet(str(tmp_path / "out"))
        assert len(spark.read.parquet(str(tmp_path / "out")).inputFiles()) > 12
        (tmp_path / "two").write_bytes(b"x" * 700)
        assert session.bytes_under(spark, str(tmp_path / "two")) == 700
    finally:
        spark.conf.unset(first)
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)


def test_documents_of_one_file_are_dealt_over_tasks(spark, tmp_path):
    spark.createDataFrame([(i, None if i % 3 else "x") for i in range(500)], "k int, v string").coalesce(1).write.parquet(str(tmp_path / "t"))
    one = spark.read.parquet(str(tmp_path / "t"))
    many = quality.dealt(one.select("k", F.struct("v").alias("s")))
    assert one.select(F.spark_partition_id()).distinct().count() == 1
    assert many.select(F.spark_partition_id()).distinct().count() > 1 and sorted(r.k for r in many.collect()) == list(range(500))


def test_a_shuffled_spread_join_collects_neither_side(spark):
    many = spark.createDataFrame([("a", i % 3) for i in range(9)] + [("b", 0)], "k string, salt int")
    one = spark.createDataFrame([("a", 1), ("c", 2)], "k string, v int")
    met = spread_join(many, one, ["k"], "salt", "inner", shuffled=True)
    assert met.count() == 9 and "Broadcast" not in met._jdf.queryExecution().toString()


def test_nearest_points_are_found_without_a_broadcast(spark):
    points = spark.range(300).selectExpr("id", "id / 1000 AS lat", "id / 700 AS lng")
    asked = spark.range(3).selectExpr("id AS q", "id / 100 AS qlat", "id / 100 AS qlng")
    met = geo.nearest_each(points, asked, "lat", "lng", "qlat", "qlng", "q", 2, ["id"])
    assert "Broadcast" not in met._jdf.queryExecution().toString() and met.count() == 6
