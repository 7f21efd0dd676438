"""Writing a stream's batches so that a batch that runs again changes nothing.

Where a batch goes to several sinks, a marker is set when it has been written to all, and
readers take batches up to the last marker only: a batch is in every sink or in none.
Batches run one after another, so the last marker says which are complete.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

BATCH = "batch_id"
COMPLETE = "_complete"


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    """Replace the folder of one batch. After a failure Spark repeats a batch under
    its old number, which then overwrites what the first try left."""
    df.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")


def last_complete(spark: SparkSession, out: str) -> int:
    """The last batch that all sinks under `out` have, -1 where there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    folder = path(f"{out}/{COMPLETE}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return -1
    return max((int(status.getPath().getName()) for status in files.listStatus(folder)), default=-1)


def write_sinks(sinks: Mapping[str, DataFrame], out: str, batch_id: int) -> None:
    """Write one batch to `out`/name for each sink, and mark it complete after the last.

    A batch that is marked is not written again.
    """
    spark = next(iter(sinks.values())).sparkSession
    if batch_id <= last_complete(spark, out):
        return
    for name, rows in sinks.items():
        write_batch(rows, f"{out}/{name}", batch_id)
    mark_complete(spark, out, batch_id)


def mark_complete(spark: SparkSession, out: str, batch_id: int) -> None:
    """Say that all of a batch is written under `out`. Only the last markers are kept."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    marker = path(f"{out}/{COMPLETE}/{batch_id}")
    files = marker.getFileSystem(spark._jsc.hadoopConfiguration())
    files.create(marker, True).close()
    files.delete(path(f"{out}/{COMPLETE}/{batch_id - 2}"), False)


def read_sinks(spark: SparkSession, out: str, names: Sequence[str]) -> dict[str, DataFrame] | None:
    """The sinks' rows with their batch, all up to the same batch; None before the first is complete."""
    upto = last_complete(spark, out)
    if upto < 0:
        return None
    # A literal bound on the folder column: files of other batches are not opened.
    return {name: spark.read.parquet(f"{out}/{name}").where(F.col(BATCH) <= upto) for name in names}


def start(
    stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Run `on_batch` on every batch; `once` stops when what is there now is done."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def append(stream: DataFrame, folder: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append every batch to `folder` exactly once."""
    return start(stream, lambda df, batch_id: write_batch(df, folder, batch_id), checkpoint, once)
