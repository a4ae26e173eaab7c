"""Session settings and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every job here expects. Adaptive execution merges small shuffle
# partitions, splits hot ones of joins and of rebalanced writes, and picks a broadcast only
# for a side below spark.sql.autoBroadcastJoinThreshold. It never makes more partitions than a
# shuffle begins with: that number is the session's, see ``settings_for``.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a few bytes can be much work: merge down to the number of cores, not to megabytes
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# What a task reads at most, of files or of a shuffle (compressed; sorted and hashed rows take many times that);
# the bytes of input for which a shuffle gets one more partition; and how much larger rows are than their files.
TASK_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.sources.fileCompressionFactor": "4",
}
SHUFFLE_INPUT_BYTES = 2 << 20
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def fit_tasks(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Settings with which a task holds about as much whatever the size of the input: more of it means more tasks.

    Adaptive execution alone merges shuffles down to the number of cores, and a broadcast is chosen by the size of files.
    """
    for key, value in TASK_SETTINGS.items():
        spark.conf.set(key, value)
    tasks = -(-input_bytes // SHUFFLE_INPUT_BYTES)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(tasks))
    else:
        spark.conf.unset(_INITIAL)
    return spark


def bytes_under(spark: SparkSession, folder: str) -> int:
    """Bytes of all files under a folder that Spark can read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


@contextmanager
def file_sized(spark: SparkSession, size: str = "64m"):
    """Rebalanced writes within give files of about this size, whatever suits the tasks of other work."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def settings_for(input_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for jobs over that much input: shuffles begin with enough partitions.

    Spark's default of 200 is a ceiling for adaptive execution, so 100 TB would be 500 GB a task.
    With these, partitions begin near ``partition_bytes`` and small ones are merged again.
    """
    tasks = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(tasks),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def local_session(cores: int | str = "*", app: str = "storelens", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and timings; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="storelens-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named in ``spark.checkpoint.dir``.

    Only a local master may do without the setting: there, driver and executors
    are one process, so a temporary folder is shared by definition.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/storelens/{label}-{uuid.uuid4().hex}"
