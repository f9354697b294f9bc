"""Session settings that stay where they belong."""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil

from pyspark.sql import SparkSession

from lamina.sources.versions import current_path, files_of

# The settings that the tuning reports compare.
ADAPTIVE = "spark.sql.adaptive.enabled"
BROADCAST_THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
NO_BROADCAST = "-1"
DEFAULT_BROADCAST_BYTES = "10485760"

PARTITION_BYTES = 128 * 1024 * 1024
MIN_SHUFFLE_PARTITIONS = 200
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
SHUFFLED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Bytes of files, or of shuffled rows, that a task of `bounded_session` takes at most.
TASK_BYTES = 16 * 1024 * 1024
#: Shuffle partitions for each of these that the files fill: shuffled rows take more than
#: the files do, and adaptive execution merges what is small.
PARTITIONS_PER_TASK = 4


def session_with(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session on the same cluster that differs from `spark` in these settings only.

    Spark reads settings when it plans a query, not when the frame is built. A
    frame of this session is planned under its settings whenever it runs, and the
    settings of the given session never change. Temporary views stay behind.
    """
    session = spark.newSession()
    inherited = {
        name: value
        for name, value in spark.conf.getAll.items()
        if name.startswith("spark.sql.") and session.conf.isModifiable(name)
    }
    for name, value in {**inherited, **settings}.items():
        session.conf.set(name, value)
    return session


def large_job_settings(job_bytes: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Settings for a job that reads and shuffles about this many bytes.

    Partitions have the given size, however many that makes. The driver keeps a record
    for every pair of scan task and shuffle partition: give larger partitions where it
    lacks the memory for that, and the executors spill. Adaptive execution merges small
    partitions and splits skewed ones, also where the step above a skewed join then needs
    one more shuffle.
    """
    return {
        ADAPTIVE: "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        SHUFFLE_PARTITIONS: str(max(ceil(job_bytes / partition_bytes), MIN_SHUFFLE_PARTITIONS)),
    }


def bounded_session(spark: SparkSession, *tables: str) -> SparkSession:
    """A session to read these tables in tasks of at most `TASK_BYTES` each.

    A task that sorts what it scans or joins takes memory in proportion to these bytes, and
    rows in memory are many times larger than in files. So tasks grow in number with the
    tables, and not in size. What the given session keeps smaller stays so.
    """

    def size(text: str) -> int:
        return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)

    total = 0
    for table in tables:
        files, folder = files_of(spark, current_path(spark, table))
        total += files.getContentSummary(folder).getLength()
    wanted = ceil(total * PARTITIONS_PER_TASK / TASK_BYTES)
    bounds = {
        name: f"{min(size(spark.conf.get(name)), TASK_BYTES)}b" for name in (SCAN_BYTES, SHUFFLED_BYTES)
    }
    partitions = max(wanted, int(spark.conf.get(SHUFFLE_PARTITIONS)))
    return session_with(spark, {**bounds, SHUFFLE_PARTITIONS: str(partitions)})
