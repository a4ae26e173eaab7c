"""Bucket tables that change in place, and summaries kept up by changed rows."""

import datetime as dt
import random
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from storelens.sinks import merging, summaries

DAY = dt.datetime(2020, 1, 15)


def files(root, folder):
    return sorted(p.name for p in Path(root).glob(f"{folder}/*.parquet"))


@pytest.fixture
def table(spark, tmp_path):
    t = merging.BucketTable(str(tmp_path), "a long, b string, ts timestamp_ntz, v long", ("a", "b"), "ts", "2020-01-01", "2021-01-01", slots=5)
    rows = [(i, "k", DAY + dt.timedelta(days=30 * (i % 6)), i) for i in range(60)] + [(None, "k", DAY, 7), (None, None, None, 8)]
    merging.create(spark.createDataFrame(rows, t.schema), t)
    return t


def content(spark, table):
    return {(r.a, r.b): (r.ts, r.v, r.part) for r in table.rows(spark).collect()}


def test_only_touched_buckets_are_rewritten(spark, table):
    folders = sorted(p.name for p in Path(table.root, "rows").glob("part=*"))
    assert folders == ["part=2020_01", "part=2020_02", "part=2020_03", "part=2020_04", "part=2020_05", "part=2020_06", "part=default"]
    held, before = content(spark, table), {f: files(table.root, f"rows/{f}") for f in folders}
    updates = spark.createDataFrame([(0, "k", 100, 1), (0, "k", 101, 2), (6, "k", 106, 1), (None, "k", 9, 1)], "a long, b string, v long, at int")
    assert merging.merge(spark, table, updates.drop("x"), ["at"]) == ["2020_01"]
    after = {f: files(table.root, f"rows/{f}") for f in folders}
    assert [f for f in folders if after[f] != before[f]] == ["part=2020_01"]
    want = dict(held)
    for key, v in (((0, "k"), 101), ((6, "k"), 106), ((None, "k"), 9)):
        want[key] = (held[key][0], v, held[key][2])
    assert content(spark, table) == want


def test_rows_move_enter_and_leave(spark, table):
    held = content(spark, table)
    # key 1 goes from February to June, the default bucket loses its only row, one key is new
    new = dt.datetime(2020, 3, 2)
    updates = spark.createDataFrame([(1, "k", DAY + dt.timedelta(days=150), 1), (None, None, new, 3), (500, None, new, 4)], "a long, b string, ts timestamp_ntz, v long")
    touched = merging.merge(spark, table, updates, ["v"])
    assert touched == ["2020_02", "2020_03", "2020_06", "default"]
    want = dict(held) | {(1, "k"): (DAY + dt.timedelta(days=150), 1, "2020_06"), (None, None): (new, 3, "2020_03"), (500, None): (new, 4, "2020_03")}
    assert content(spark, table) == want
    places = {(r.a, r.b): r.part for r in table.places(spark).collect()}
    assert places == {k: part for k, (_, _, part) in want.items()}
    # and back again; an emptied bucket takes rows
    assert merging.merge(spark, table, spark.createDataFrame([(None, None, None, 5)], "a long, b string, ts timestamp_ntz, v long"), ["v"]) == ["2020_03", "default"]
    assert content(spark, table) == want | {(None, None): (None, 5, "default")}
    assert merging.merge(spark, table, updates.limit(0), ["v"]) == []


def test_nulls_keep_values_if_asked(spark, table):
    updates = spark.createDataFrame([(2, "k", None, 77)], "a long, b string, ts timestamp_ntz, v long")
    merging.merge(spark, table, updates, ["v"], keep_when_null=True)
    assert content(spark, table)[(2, "k")] == (DAY + dt.timedelta(days=60), 77, "2020_03")


def test_summary_follows_changes(spark):
    rnd = random.Random(5)
    schema = "id long, g string, h long, x decimal(10,2), y long"
    row = lambda i: (i, rnd.choice(["a", "b", None]), rnd.choice([1, None]), rnd.choice([None, Decimal(rnd.randrange(-500, 500)) / 100]), rnd.choice([None, rnd.randrange(9)]))
    table = {i: row(i) for i in range(80)} | {900: (900, "lone", 1, Decimal("1.00"), 3)}
    frame = lambda rows: spark.createDataFrame(list(rows), schema).drop("id")
    state = summaries.build(frame(table.values()), ["g", "h"], ["x", "y"])
    shown = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    for step in range(3):
        gone = [table.pop(i) for i in rnd.sample(sorted(set(table) - {900}), 15)] + ([table.pop(900)] if step == 1 else [])
        came = [row(1000 * (step + 1) + i) for i in range(10)]
        for i in rnd.sample(sorted(set(table) - {900}), 10):
            gone.append(table[i])
            table[i] = row(i)
            came.append(table[i])
        table.update({r[0]: r for r in came})
        state = summaries.refresh(state, summaries.changes(frame(gone), frame(came)), ["g", "h"], ["x", "y"], frame(table.values()))
        assert shown(state) == shown(summaries.build(frame(table.values()), ["g", "h"], ["x", "y"]))
        state = spark.createDataFrame(state.collect(), state.schema)
    assert "lone" not in {r.g for r in state.collect()}


def test_only_groups_that_lost_an_end_are_read(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("a", 3), ("b", 2)], "g string, x long")
    state = summaries.build(df, ["g"], ["x"])
    # the table at hand says otherwise: it is only asked about "b"
    other = spark.createDataFrame([("a", 99), ("b", 7)], "g string, x long")
    gone = spark.createDataFrame([("a", 3), ("b", 2)], "g string, x long")
    came = spark.createDataFrame([("b", 7)], "g string, x long")
    got = {r.g: (r.n, r.x_sum, r.x_min, r.x_max) for r in summaries.refresh(state, summaries.changes(gone, came), ["g"], ["x"], other).collect()}
    assert got == {"a": (2, 6, 1, 5), "b": (1, 7, 7, 7)}
    with pytest.raises(ValueError, match="decimal"):
        summaries.build(df.withColumn("x", F.col("x").cast("double")), ["g"], ["x"])
