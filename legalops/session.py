"""Session settings the operators rely on, and the shared folder for written steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Partitions are joined up to this size as they were sent. Sorted and grouped in one task
    # their rows take some 28 times as much, and several tasks share an executor's memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A third of a join's rows may share one key: let such partitions be split even
    # where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables in buckets of some of a join's keys are co-located; do not deal them anew.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Do not look up the Python call site of every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A repeated write replaces only the month or batch folders it touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, app: str = "legalops") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def spread(df: DataFrame, *columns: str, tasks: int | None = None) -> DataFrame:
    """The rows dealt over as many partitions as the session shuffles into, or `tasks`, by `columns` or else in turn.

    For rows that are few or narrow where they are read but come to much in the next step:
    Spark joins partitions that are small before it. Those of a given number it leaves as they are.
    """
    return df.repartition(tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of what runs inside as soon as it has run, for steps that are written and not run again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


# Folders handed out in this process and not deleted since.
_handed_out: list[str] = []


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the session's checkpoint folder.

    What is written there stays until `drop_staged`.

    On a cluster that folder is shared by all executors. Only where the session
    names none, as in local tests, is one made and set.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="legalops-"))
        root = context.getCheckpointDir()
    _handed_out.append(f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _handed_out[-1]


def drop_staged(spark: SparkSession) -> int:
    """Delete the folders of all steps that this process wrote; gives their number.

    Frames built on them can no longer be read, so call it when their results are stored.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    dropped = 0
    while _handed_out:
        folder = path(_handed_out.pop())
        dropped += folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return dropped
