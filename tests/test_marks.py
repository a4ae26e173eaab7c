"""The low-water mark of the event job: late events, replays, and what is read."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from storelens.streaming import outbox


def event(i, agg, at, payload):
    return {"event_id": f"e{i}", "aggregate_type": "order", "aggregate_id": agg, "event_type": "t", "payload": payload, "created_at": at, "retries": 0}


@pytest.fixture
def job(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()

    class Job:
        root = str(tmp_path / "out")

        def add(self, name, *events):
            (feed / name).write_text("\n".join(json.dumps(e) for e in events))

        def run(self, **options):
            stream = outbox.read_events(spark, str(feed), max_files=1)
            outbox.apply_events(stream, self.root, "status string", str(tmp_path / "ck"), **options).awaitTermination()
            return {r.aggregate_id: r.status for r in outbox.current_documents(spark, self.root).collect()}

        def events(self):
            return spark.read.schema(outbox.EVENTS).json(str(feed))

        def ids(self):
            return sorted(r[0] for r in outbox.processed_ids(spark, self.root).collect())

        def compact(self, settled):
            target = self.root + "x"
            outbox.compact(spark, self.root, target, settled)
            self.root = target

        def mark(self):
            return outbox.low_water_mark(spark, self.root)

    return Job()


DAY1 = [event(1, "o1", "2018-01-01T01:00:00Z", '{"status":"a"}'), event(2, "o2", "2018-01-01T02:00:00Z", '{"status":"a"}'), event(3, "o3", "2018-01-01T02:00:00Z", "{no")]


def test_pending_events_do_not_depend_on_those_before_the_mark(spark, job):
    job.add("a.json", *DAY1)
    job.add("b.json", event(4, "o1", "2018-01-05T00:00:00Z", '{"status":"b"}'))
    assert job.run() == {"o1": "b", "o2": "a"} and job.mark() is None
    known = outbox.processed_ids(spark, job.root).union(outbox.rejected(spark, job.root).select("event_id"))
    settled = outbox.settled_until(job.events(), known)
    assert settled == dt.datetime(2018, 1, 5)
    job.compact(settled)
    # ids of the first day are gone, and so are their events from what is looked at
    assert job.mark() == "2018-01-05" and job.ids() == ["e4"]
    job.add("c.json", event(5, "o2", "2018-01-06T00:00:00Z", '{"status":"c"}'))
    left = outbox.pending(job.events(), outbox.processed_ids(spark, job.root), job.mark())
    assert [r.event_id for r in left.collect()] == ["e5"]
    # late: from below the mark, for a document with nothing newer and for one with; replayed: from both sides of the mark
    job.add("d.json", event(6, "o9", "2018-01-02T00:00:00Z", '{"status":"late"}'), event(7, "o1", "2018-01-02T00:00:00Z", '{"status":"old"}'), DAY1[0],
            event(4, "o1", "2018-01-05T00:00:00Z", '{"status":"b"}'))
    assert job.run() == {"o1": "b", "o2": "c", "o9": "late"}
    assert job.ids() == ["e4", "e5"]
    assert outbox.pending(job.events(), outbox.processed_ids(spark, job.root), job.mark()).count() == 0
    # a mark never goes back
    job.compact(dt.datetime(2017, 1, 1))
    assert job.mark() == "2018-01-05" and job.run() == {"o1": "b", "o2": "c", "o9": "late"}


def test_marks_leave_files_out(spark, job, tmp_path):
    job.add("a.json", *DAY1, event(4, "o1", "2018-01-05T00:00:00Z", '{"status":"b"}'))
    job.run()
    handled = outbox._since(outbox._handled(spark, job.root), "2018-01-05")
    assert handled.count() == 1
    assert "PartitionFilters: [isnotnull(day" in handled._jdf.queryExecution().toString()
    spark.createDataFrame([(e["event_id"], e["created_at"]) for e in DAY1], "event_id string, at string").select(
        "event_id", F.col("at").cast("timestamp").alias("created_at")
    ).write.parquet(str(tmp_path / "events"))
    left = outbox.pending(spark.read.parquet(str(tmp_path / "events")), handled.select("event_id"), "2018-01-05")
    assert "GreaterThanOrEqual(created_at" in left._jdf.queryExecution().toString()


def test_repeats_are_left_out_of_the_stream(spark, job):
    job.add("a.json", DAY1[0], DAY1[0])
    assert job.run(repeats_within="2 days") == {"o1": "a"}
    job.add("b.json", DAY1[0], event(8, "o2", "2018-01-01T03:00:00Z", '{"status":"x"}'))
    assert job.run(repeats_within="2 days") == {"o1": "a", "o2": "x"}
    seen = spark.read.parquet(f"{job.root}/processed").groupBy("event_id").count().collect()
    assert sorted(tuple(r) for r in seen) == [("e1", 1), ("e8", 1)]


def test_undated_events_are_never_below_the_mark(spark):
    events = spark.createDataFrame([("a", None), ("b", dt.datetime(2018, 1, 1))], "event_id string, created_at timestamp")
    none = spark.createDataFrame([], "event_id string")
    assert [r.event_id for r in outbox.pending(events, none, "2019-01-01").collect()] == ["a"]
    assert outbox.settled_until(events.limit(0), none) is None
