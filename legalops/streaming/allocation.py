"""Allocation of payments that arrive among the documents they pay, as they arrive.

An agreement's state is two numbers: how far its documents reach on the line (see
`operators.allocation`) and how far its payments do, the second never beyond the
first. A batch is placed with built-in functions by the scan of `operators.arrivals`,
started from the state of the batch's agreements. What a batch changed is written under
its number, beside the events it placed; a batch that runs again reads states of earlier
batches only, so it writes the same rows.

Events may come late. With a lateness, an event waits until the stream is that much past
its arrival: the events of a batch that need not wait any longer, and those held back by
batches before it, are placed together in the order of arrival. What still waits is
written under the batch's number. An event that comes later than that cannot be placed in
its order; it is kept in a folder of its own.

State rows are appended, one per agreement and batch. Every COMPACT_EVERY batches the
latest state of every agreement is written anew, so that a batch reads one full state
and at most that many changes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from legalops.operators.allocation import AGREEMENT
from legalops.operators.arrivals import DOCUMENT, EVENT_SCHEMA, PLACED_SCHEMA, STATE, place_events
from legalops.sources.tables import stage
from legalops.streaming.sink import BATCH, last_complete, mark_complete, start, write_batch

STATE_SCHEMA = "id_client long, cooperation_agreement_no long, owed_before long, paid_before long"
COMPACT_EVERY = 16


def _folder(root: str, kind: str, batch_id: int) -> str:
    return f"{root}/{kind}/{BATCH}={batch_id}"


def _latest(changes: DataFrame) -> DataFrame:
    """The state that the last batch of each agreement left."""
    last = F.max_by(F.struct(*STATE), BATCH).alias("state")
    return changes.groupBy(*AGREEMENT).agg(last, F.max(BATCH).alias(BATCH)).select(*AGREEMENT, BATCH, "state.*")


def _read(spark: SparkSession, root: str, kind: str, first: int, after: int) -> DataFrame | None:
    """State rows of the batches first <= number < after; None where there are none."""
    folders = [_folder(root, kind, n) for n in range(first, after)]
    if not folders:
        return None
    return spark.read.schema(f"{STATE_SCHEMA}, {BATCH} long").option("basePath", f"{root}/{kind}").parquet(*folders)


def state_before(spark: SparkSession, root: str, batch_id: int, of: DataFrame | None = None) -> DataFrame | None:
    """The state of agreements that had events before this batch: of those in `of`, or of all.

    None where no batch came before.
    """
    full_at = max(batch_id - 1, 0) // COMPACT_EVERY * COMPACT_EVERY
    parts = [_read(spark, root, "full", full_at, full_at + 1) if full_at else None]
    parts.append(_read(spark, root, "changes", full_at, batch_id))
    found = [p for p in parts if p is not None]
    if not found:
        return None
    changes = reduce(DataFrame.unionByName, found)
    if of is not None:
        changes = changes.join(of.select(*AGREEMENT).distinct(), AGREEMENT, "left_semi")
    return _latest(changes)


def _changed(placed: DataFrame, before: DataFrame | None) -> DataFrame:
    """The state that a batch leaves for each of its agreements.

    Both lines only grow, so each ends where its last row does.
    """
    is_document = F.col("kind") == DOCUMENT
    ends = placed.groupBy(*AGREEMENT).agg(
        F.max(F.when(is_document, F.col("ends_at"))).alias("_owed"),
        F.max(F.when(~is_document, F.col("ends_at"))).alias("_paid"),
    )
    if before is not None:
        ends = ends.join(before.select(*AGREEMENT, *STATE), AGREEMENT, "left")
    else:
        ends = ends.select("*", *[F.lit(0).cast("long").alias(c) for c in STATE])
    return ends.select(
        *AGREEMENT,
        *[F.coalesce(made, kept, F.lit(0)).cast("long").alias(kept) for made, kept in zip(("_owed", "_paid"), STATE)],
    )


def _waiting(spark: SparkSession, out: str, batch_id: int) -> tuple[DataFrame, int | None]:
    """The events that wait after a batch, and how far the stream had come then: all before that are placed."""
    if batch_id < 0:
        return spark.createDataFrame([], EVENT_SCHEMA), None
    held = spark.read.schema(EVENT_SCHEMA).parquet(_folder(f"{out}-state", "waiting", batch_id))
    mark = spark.read.schema("placed_to long").parquet(_folder(f"{out}-state", "marks", batch_id)).first()
    return held, mark["placed_to"]


def _release(batch: DataFrame, out: str, batch_id: int, lateness: int) -> DataFrame:
    """The events to be placed now. Writes those that wait on, those too late, and how far the stream is."""
    spark, state = batch.sparkSession, f"{out}-state"
    held, placed_to = _waiting(spark, out, batch_id - 1)
    batch = stage(batch.select(*held.columns), f"{state}/batch")
    arrival = F.col("arrival")
    # An event without an arrival comes before all others, and so is late for everything but the first batch.
    late = F.coalesce(arrival <= F.lit(placed_to), F.lit(placed_to is not None)) if placed_to is not None else F.lit(False)
    write_batch(batch.where(late), f"{out}-late", batch_id)
    newest = batch.agg(F.max("arrival")).first()[0]
    reached = [x for x in (placed_to, None if newest is None else newest - lateness) if x is not None]
    now = max(reached, default=None)
    known = held.unionByName(batch.where(~late))
    due = F.coalesce(arrival <= F.lit(now), F.lit(True)) if now is not None else arrival.isNull()
    stage(known.where(~due), _folder(state, "waiting", batch_id))
    mark = spark.range(1).select(F.lit(now).cast("long").alias("placed_to"))
    stage(mark, _folder(state, "marks", batch_id))
    return known.where(due)


def placed_so_far(spark: SparkSession, out: str) -> DataFrame:
    """The log in `out` and the events that still wait, placed as if no more came before them."""
    last = last_complete(spark, out)
    log = spark.read.schema(f"{PLACED_SCHEMA}, {BATCH} long").option("basePath", out).parquet(out)
    log = log.where(F.col(BATCH) <= last).drop(BATCH)
    held, _ = _waiting(spark, out, last)
    rest = place_events(held, before=state_before(spark, f"{out}-state", last + 1, of=held))
    return log.unionByName(rest)


def late_events(spark: SparkSession, out: str) -> DataFrame:
    """Events that came too late to be placed in their order, with their batch."""
    return spark.read.schema(f"{EVENT_SCHEMA}, {BATCH} long").option("basePath", f"{out}-late").parquet(f"{out}-late")


def record_arrivals(
    events: DataFrame, out: str, checkpoint: str, once: bool = False, lateness: int | None = None
) -> StreamingQuery:
    """Append the placed events to the log in `out`; the agreements' state is kept beside it.

    Without `lateness` every event is placed in the batch it comes in. With it, events may
    come in any order within that much: one with arrival a is placed in its order if
    nothing of a + lateness or later came before it. Others are `late_events`.
    """
    state = f"{out}-state"

    def place(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if lateness is not None:
            if batch_id <= last_complete(spark, out):
                return
            batch = _release(batch, out, batch_id, lateness)
        before = state_before(spark, state, batch_id, of=batch)
        if before is not None:
            before = stage(before, f"{state}/before")
        write_batch(place_events(batch, before=before), out, batch_id)
        placed = spark.read.schema(PLACED_SCHEMA).parquet(f"{out}/{BATCH}={batch_id}")
        stage(_changed(placed, before), _folder(state, "changes", batch_id))
        if batch_id and batch_id % COMPACT_EVERY == 0:
            earlier = state_before(spark, state, batch_id)
            whole = _latest(earlier.unionByName(_read(spark, state, "changes", batch_id, batch_id + 1)))
            stage(whole.drop(BATCH), _folder(state, "full", batch_id))
        if lateness is not None:
            mark_complete(spark, out, batch_id)

    return start(events, place, checkpoint, once)
