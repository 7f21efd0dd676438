"""Allocation of payments that arrive among the documents they pay, from a log of events.

Events are (agreement, kind, id, amount, arrival); arrival rises with the order of
arrival in an agreement, ids settle repeats. Placed, an event has
the stretch of the agreement's line it covers (see `operators.allocation`) and, for
a payment, what it had over. `legalops.streaming.allocation` writes the same rows
for events as they arrive; here a whole log is placed at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legalops.functions.scans import BLOCK, in_blocks, null_safe_join, of_cut_groups
from legalops.operators.allocation import AGREEMENT, match_positions

DOCUMENT, PAYMENT = "DOCUMENT", "PAYMENT"

EVENT_SCHEMA = "id_client long, cooperation_agreement_no long, kind string, id long, amount long, arrival long"
# An agreement's state between events: how far its documents and its payments reach.
STATE = ("owed_before", "paid_before")
PLACED_SCHEMA = (
    "id_client long, cooperation_agreement_no long, kind string, id long,"
    "starts_at long, ends_at long, leftover long"
)


def place_events(events: DataFrame, blocks: int | None = None, before: DataFrame | None = None) -> DataFrame:
    """Place a log of documents and payments on their agreements' lines.

    `before` has the agreement and STATE, one row per agreement: where its lines end
    before these events. Without a row they start at 0.

    Every event is placed. One that lacks its client or agreement is on nobody's line: its
    stretch is empty, and a payment's whole amount is left over.

    One pass over blocks gives what is owed and paid so far and how far payments were
    ahead at most. A block's most is counted from its own start, so it moves by what the
    blocks before it add up to.
    """
    is_document = F.col("kind") == DOCUMENT
    order = ["arrival", "id"]
    held = in_blocks(
        events.select(
            "*",
            F.when(is_document, F.col("amount")).otherwise(0).alias("_owed"),
            F.when(is_document, 0).otherwise(F.col("amount")).alias("_paid"),
        ),
        AGREEMENT,
        order,
        blocks,
    )
    inside = Window.partitionBy(*AGREEMENT, BLOCK).orderBy(*order)
    upto, earlier = (inside.rowsBetween(Window.unboundedPreceding, last) for last in (0, -1))

    def scanned(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_owed_to", F.sum("_owed").over(upto)).withColumn("_paid_in", F.sum("_paid").over(upto))
        rows = rows.withColumn("_ahead", F.col("_paid_in") - F.col("_owed_to"))
        return rows.withColumn("_most", F.max("_ahead").over(earlier))

    # What the earlier blocks of an agreement that is cut come to: at most two rows a block. Only
    # the rows of these agreements are scanned for it.
    totals = scanned(of_cut_groups(held, AGREEMENT)).groupBy(*AGREEMENT, BLOCK).agg(
        F.sum("_owed").alias("_owed"), F.sum("_paid").alias("_paid"), F.max("_ahead").alias("_most")
    )
    in_order = Window.partitionBy(*AGREEMENT).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    for side in ("owed", "paid"):
        totals = totals.withColumn(f"_{side}_carry", F.coalesce(F.sum(f"_{side}").over(in_order), F.lit(0)))
    reached = F.col("_paid_carry") - F.col("_owed_carry") + F.col("_most")
    carried = totals.withColumn("_reached", reached).select(
        *AGREEMENT, BLOCK, "_owed_carry", "_paid_carry", F.max("_reached").over(in_order).alias("_most_carry")
    )

    rows = null_safe_join(scanned(held), F.broadcast(carried), [*AGREEMENT, BLOCK], "left")
    if before is None:
        rows = rows.select("*", *[F.lit(0).cast("long").alias(c) for c in STATE])
    else:
        # Where a part of the agreement is null there is no line, and no state is found.
        rows = rows.join(before.select(*AGREEMENT, *STATE), AGREEMENT, "left")
    since = {side: F.coalesce(f"{side}_before", F.lit(0)) for side in ("owed", "paid")}
    so_far = {side: since[side] + F.coalesce(f"_{side}_carry", F.lit(0)) for side in ("owed", "paid")}
    rows = rows.select(
        *AGREEMENT,
        "kind",
        "id",
        "amount",
        (so_far["owed"] + F.col("_owed_to")).alias("owed_to"),
        (so_far["paid"] + F.col("_paid_in")).alias("paid_in"),
        # What has been dropped in all is the most that payments were ever ahead.
        F.greatest(
            F.lit(0), since["paid"] - since["owed"] + F.col("_most_carry"), so_far["paid"] - so_far["owed"] + F.col("_most")
        ).alias("dropped_before"),
    )
    dropped = F.greatest(F.col("dropped_before"), F.col("paid_in") - F.col("owed_to"))
    starts_at = F.when(is_document, F.col("owed_to") - F.col("amount")).otherwise(
        F.col("paid_in") - F.col("amount") - F.col("dropped_before")
    )
    ends_at = F.when(is_document, F.col("owed_to")).otherwise(F.col("paid_in") - dropped)
    leftover = dropped - F.col("dropped_before")
    known = F.col("id_client").isNotNull() & F.col("cooperation_agreement_no").isNotNull()
    nothing = F.lit(0).cast("long")
    return rows.select(
        *AGREEMENT,
        "kind",
        "id",
        F.when(known, starts_at).otherwise(nothing).alias("starts_at"),
        F.when(known, ends_at).otherwise(nothing).alias("ends_at"),
        F.when(is_document, nothing).when(known, leftover).otherwise(F.col("amount")).cast("long").alias("leftover"),
    )


def _side(placed: DataFrame, kind: str) -> DataFrame:
    return placed.where((F.col("kind") == kind) & (F.col("ends_at") > F.col("starts_at"))).select(
        *AGREEMENT, "id", "starts_at", "ends_at"
    )


def allocations(placed: DataFrame, blocks: int | None = None) -> DataFrame:
    """Which payment settled how much of which document."""
    return match_positions(_side(placed, DOCUMENT), _side(placed, PAYMENT), blocks)


def leftovers(placed: DataFrame) -> DataFrame:
    """What each payment had over when it arrived."""
    return placed.where((F.col("kind") == PAYMENT) & (F.col("leftover") > 0)).select(
        *AGREEMENT, F.col("id").alias("id_payment_bundle"), "leftover"
    )
