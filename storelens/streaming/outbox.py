"""Outbox events, applied to a document table by a streaming job.

Each micro-batch writes three small folders named after its number: the newest value per
document and field, the ids it handled, and the events it could not read. A batch that runs
again after a failure overwrites its own folders, and a field's current value is always that of
the newest event, by (event time, event id), that carries the field, so replays, repeats and late
events change nothing that is newer. A field that an event leaves out keeps its value; an
explicit null sets it to null. Work per batch grows with the batch; ``compact`` bounds what readers
read by the documents there are and by the events since the low-water mark.

Handled ids lie in folders by the day of their event. Below the mark everything is settled: ids are
given up there, and looking for pending events reads neither events nor ids from before it. An event that comes
late or again from below the mark is still applied, which changes nothing newer.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelens.operators.aggregates import first_row_per_key, last_row_per_key
from storelens.sinks.upserts import upsert

EVENTS = (
    "event_id string, aggregate_type string, aggregate_id string, event_type string, "
    "payload string, created_at timestamp, retries int"
)


def read_events(
    spark: SparkSession, path: str, schema: str | T.StructType = EVENTS, max_files: int | None = None
) -> DataFrame:
    """A stream over a folder to which event files are added; ``max_files`` bounds a batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def split_events(events: DataFrame, body: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """Readable events with a parsed ``body``, and the rest with one more retry."""
    readable = (
        F.col("event_id").isNotNull()
        & F.col("aggregate_id").isNotNull()
        & F.coalesce(
            F.schema_of_variant(F.try_parse_json("payload")).startswith("OBJECT"), F.lit(False)
        )
    )
    good = events.filter(readable).withColumns(
        {"body": F.from_json("payload", body), "carried": F.json_object_keys("payload")}
    )
    bad = events.filter(~readable).withColumn(
        "retries", F.coalesce("retries", F.lit(0)) + F.lit(1)
    )
    return good, bad


def newest_changes(good: DataFrame) -> DataFrame:
    """One row per document: for each field the newest event that carries it, with its value.

    ``aggregate_type, aggregate_id, created_at, event_id`` of the newest event, and one struct
    ``created_at, event_id, value`` for each field of the body, null if no event carries it.
    """
    once = first_row_per_key(good, ["event_id"], ["created_at"])
    names = once.schema["body"].dataType.names
    fields = [
        F.when(
            F.array_contains("carried", n),
            F.struct("created_at", "event_id", F.col(f"body.`{n}`").alias("value")),
        ).alias(n)
        for n in names
    ]
    return _newest(once.select("aggregate_type", "aggregate_id", "created_at", "event_id", F.struct(*fields).alias("fields")))


def _newest(changes: DataFrame) -> DataFrame:
    """Changes of a document put together, field by field."""
    names = changes.schema["fields"].dataType.names
    event = F.struct("created_at", "event_id")

    def newest(n: str) -> Column:
        f = F.col(f"fields.`{n}`")
        place = F.when(f.isNotNull(), F.struct(f["created_at"].alias("created_at"), f["event_id"].alias("event_id")))
        return F.max_by(f, place).alias(n)

    merged = changes.groupBy("aggregate_type", "aggregate_id").agg(
        F.max(event).alias("event"), F.struct(*map(newest, names)).alias("fields")
    )
    return merged.select(
        "aggregate_type", "aggregate_id", "event.created_at", "event.event_id", "fields"
    )


def without_repeats(events: DataFrame, within: str) -> DataFrame:
    """The stream without events that were seen ``within`` that time; the ids in between are all its state.

    Events that are further behind the newest than that are left out by Spark, so it is for feeds that are never so late.
    """
    return events.withWatermark("created_at", within).dropDuplicatesWithinWatermark(["event_id"])


def apply_events(
    events: DataFrame, root: str, body: str | T.StructType, checkpoint: str, repeats_within: str | None = None
) -> StreamingQuery:
    """Start the job: handle everything there is, then stop. Run it again for later events.

    The checkpoint remembers which events were handled; ``root`` and ``checkpoint`` must be
    in shared storage. Repeats never change a document; with ``repeats_within`` they are not even
    handled again, see ``without_repeats``.
    """
    if repeats_within is not None:
        events = without_repeats(events, repeats_within)

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            good, bad = split_events(held, body)
            folder = f"batch_id={batch_id}"
            newest_changes(good).write.mode("overwrite").parquet(f"{root}/changes/{folder}")
            ids = good.groupBy("event_id").agg(F.current_timestamp().alias("processed_at"), F.min("created_at").alias("created_at"))
            _by_day(ids).write.mode("overwrite").partitionBy("day").parquet(f"{root}/processed/{folder}")
            bad.write.mode("overwrite").parquet(f"{root}/rejected/{folder}")
        finally:
            held.unpersist()

    return (
        events.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_documents(spark: SparkSession, root: str) -> DataFrame:
    """The newest state of every document the events have touched.

    ``set_fields`` names the fields that some event carried; the others are null because unknown.
    """
    newest = _newest(spark.read.parquet(f"{root}/changes").drop("batch_id"))
    names = newest.schema["fields"].dataType.names
    carried = F.array(*(F.when(F.col(f"fields.`{n}`").isNotNull(), F.lit(n)) for n in names))
    return newest.select(
        "aggregate_type",
        "aggregate_id",
        *(F.col(f"fields.`{n}`.value").alias(n) for n in names),
        F.col("created_at").alias("updated_at"),
        F.array_compact(carried).alias("set_fields"),
    )


def fold_into(base: DataFrame, documents: DataFrame, key: str, aggregate_type: str) -> DataFrame:
    """Merge the documents of one type into its full table.

    Fields that no event carried keep the base's value, also in rows whose ``set_fields`` is missing only
    where the change is null; documents of other types stay out.
    """
    changes = documents.filter(F.col("aggregate_type") == aggregate_type).drop("aggregate_type")
    if "set_fields" not in changes.columns:
        changes = changes.withColumnRenamed("aggregate_id", key)
        return upsert(base, changes, [key], ["updated_at"], keep_when_null=True)
    newest = last_row_per_key(changes, ["aggregate_id"], ["updated_at"])
    b, c = base.alias("b"), newest.alias("c")
    joined = b.join(c, F.col(f"b.{key}") == F.col("c.aggregate_id"), "full_outer")
    out = [F.coalesce(F.col(f"b.{key}"), F.col("c.aggregate_id")).alias(key)]
    fields = [n for n in newest.columns if n not in ("aggregate_id", "set_fields", key)]
    for name in [*(n for n in base.columns if n != key), *(n for n in fields if n not in base.columns)]:
        if name not in fields:
            out.append(F.col(f"b.{name}").alias(name))
            continue
        old = F.col(f"b.{name}") if name in base.columns else F.lit(None)
        hit = F.col("c.aggregate_id").isNotNull() if name == "updated_at" else F.array_contains("c.set_fields", name)
        out.append(F.when(F.coalesce(hit, F.lit(False)), F.col(f"c.{name}")).otherwise(old).alias(name))
    return joined.select(*out)


def _by_day(ids: DataFrame) -> DataFrame:
    return ids.withColumn("day", F.coalesce(F.date_format("created_at", "yyyy-MM-dd"), F.lit("unknown")))


def _handled(spark: SparkSession, root: str) -> DataFrame:
    schema = "event_id string, processed_at timestamp, created_at timestamp, batch_id bigint, day string"
    return spark.read.schema(schema).parquet(f"{root}/processed")


def compact(spark: SparkSession, root: str, target: str, settled: dt.datetime | None = None) -> None:
    """Write the newest state, the handled ids and the rejected events of ``root`` to a new root.

    One row per document, and per event since the low-water mark, whatever the number of batches. ``settled``, from
    ``settled_until``, moves the mark up to that day; it never goes back. Run it between runs of the
    job, and use ``target`` as the root from then on, with the same checkpoint; the old root can go when nothing reads it.
    """
    folder = "batch_id=-1"
    _newest(spark.read.parquet(f"{root}/changes").drop("batch_id")).write.parquet(f"{target}/changes/{folder}")
    mark = max(filter(None, (low_water_mark(spark, root), settled and settled.strftime("%Y-%m-%d"))), default=None)
    if mark is not None:
        spark.createDataFrame([(mark,)], "day string").write.parquet(f"{target}/mark")
    ids = _since(_handled(spark, root), mark).groupBy("event_id").agg(F.max("processed_at").alias("processed_at"), F.min("created_at").alias("created_at"))
    _by_day(ids).write.partitionBy("day").parquet(f"{target}/processed/{folder}")
    rejected(spark, root).distinct().write.parquet(f"{target}/rejected/{folder}")


def low_water_mark(spark: SparkSession, root: str) -> str | None:
    """The day, as ``yyyy-MM-dd``, before which all events are settled; none before the first compaction with one."""
    try:
        return spark.read.schema("day string").parquet(f"{root}/mark").agg(F.max("day")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _since(handled: DataFrame, mark: str | None) -> DataFrame:
    """Ids of events from the mark on; whole folders are left out. Undated events are never below it."""
    return handled if mark is None else handled.filter(F.col("day") >= mark)


def processed_ids(spark: SparkSession, root: str) -> DataFrame:
    """Ids of handled events from the low-water mark on; empty before the first batch."""
    try:
        return _since(_handled(spark, root), low_water_mark(spark, root)).select("event_id").distinct()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "event_id string")


def rejected(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rejected").drop("batch_id")


def pending(events: DataFrame, handled: DataFrame, mark: str | None = None) -> DataFrame:
    """Events no batch has handled yet, oldest first; with the low-water mark, those from it on.

    The mark goes to the scan of the events, as ``processed_ids`` left it out of the ids: what is read grows with
    the events since then, not with all there ever were.
    """
    if mark is not None:
        events = events.filter(F.col("created_at").isNull() | (F.col("created_at") >= F.lit(mark).cast(events.schema["created_at"].dataType)))
    return events.join(handled, "event_id", "left_anti").orderBy("created_at", "event_id")


def settled_until(events: DataFrame, handled: DataFrame, mark: str | None = None) -> dt.datetime | None:
    """The time before which every event is handled: that of the oldest pending one, else of the newest event."""
    waiting = pending(events, handled, mark).agg(F.min("created_at")).first()[0]
    return waiting if waiting is not None else events.agg(F.max("created_at")).first()[0]


def pending_count(events: DataFrame) -> DataFrame:
    return events.filter(F.col("processed_at").isNull()).agg(F.count("*").alias("pending"))
