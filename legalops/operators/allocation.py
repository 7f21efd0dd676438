"""First-in-first-out allocation of payments to the documents of an agreement.

Laid end to end by id, the documents of an agreement cover a line from 0 to what
is owed and its payments a line from 0 to what was paid. A payment settles a
document as far as their stretches of the line overlap.

This holds when all documents precede all payments. Where they arrive mixed, a
payment sees only the documents already there and drops what it has over, so it
reaches no farther along the line than they do. `operators.arrivals` places such
events, and `match_positions` pairs them all the same.

An agreement is scanned in blocks of rows (`functions.scans`), so it may be of any size.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.functions.scans import Running, running
from legalops.session import shared_folder
from legalops.sources.tables import stage

AGREEMENT = ["id_client", "cooperation_agreement_no"]


def place(rows: DataFrame, id_column: str, amount: str, blocks: int | None = None) -> DataFrame:
    """Lay an agreement's rows end to end by id: adds where each starts and ends."""
    placed = running(rows, AGREEMENT, [id_column], [Running("ends_at", F.col(amount))], blocks)
    return placed.withColumn("starts_at", F.col("ends_at") - F.col(amount))


def _stretches(placed: DataFrame, id_column: str) -> DataFrame:
    # A row of nothing covers no stretch of the line, and one without an agreement is on none.
    known = F.col("id_client").isNotNull() & F.col("cooperation_agreement_no").isNotNull()
    return placed.where((F.col("ends_at") > F.col("starts_at")) & known).select(
        *AGREEMENT, F.col(id_column).alias("id"), "starts_at", "ends_at"
    )


def match_positions(documents: DataFrame, payments: DataFrame, blocks: int | None = None) -> DataFrame:
    """Amounts by which placed documents and payments overlap.

    Both have (agreement, id, starts_at, ends_at). An overlap starts where its
    document or its payment starts, so each start asks for the other side's row that
    began last before it: a running maximum along the line. That is one row in and
    at most one row out, however many documents and payments an agreement has.
    """
    row = F.struct("starts_at", "ends_at", "id").alias("row")
    none = F.lit(None).cast("struct<starts_at: bigint, ends_at: bigint, id: bigint>")
    starts = documents.select(
        *AGREEMENT, "starts_at", F.lit(1).alias("side"), row.alias("document"), none.alias("payment")
    ).unionByName(
        payments.select(
            *AGREEMENT, "starts_at", F.lit(0).alias("side"), none.alias("document"), row.alias("payment")
        )
    )
    # Payments sort first on a shared start: the document there sees the payment,
    # and the payment sees earlier documents only, so the pair comes out once.
    met = running(
        starts,
        AGREEMENT,
        ["starts_at", "side"],
        [Running("doc", F.col("document"), "max"), Running("pay", F.col("payment"), "max")],
        blocks,
    )
    amount = F.least("doc.ends_at", "pay.ends_at") - F.col("starts_at")
    return (
        met.where(F.col("doc").isNotNull() & F.col("pay").isNotNull())
        .select(
            *AGREEMENT,
            F.col("doc.id").alias("id_payment_document"),
            F.col("pay.id").alias("id_payment_bundle"),
            amount.alias("allocated"),
        )
        .where(F.col("allocated") > 0)
    )


def _beyond_line_end() -> Column:
    """How much of a stretch lies beyond the end of the other side's line."""
    start = F.greatest(F.col("starts_at"), F.coalesce(F.col("line_end"), F.lit(0)))
    return F.greatest(F.col("ends_at") - start, F.lit(0))


class Allocation:
    """What settles what. Each frame is built when it is first asked for.

    allocations: which payment settled how much of which document. documents_after: all
    documents with what is still owed. leftovers: what a payment had over. What is settled
    of a line ends where the shorter of the two lines ends, so the last two need the
    running sums of one side and the totals of the other, and no matching.
    """

    def __init__(self, documents: DataFrame, payments: DataFrame, blocks: int | None = None):
        self.documents, self.payments, self.blocks = documents, payments, blocks

    @cached_property
    def _owed(self) -> DataFrame:
        return place(self.documents, "id_payment_document", "amount", self.blocks)

    @cached_property
    def _paid(self) -> DataFrame:
        return place(self.payments, "id_payment_bundle", "total_amount", self.blocks)

    @cached_property
    def allocations(self) -> DataFrame:
        # Written, so that sampling them for the blocks of the match does not scan again.
        owed, paid = (
            stage(_stretches(placed, id_column), shared_folder(placed.sparkSession, "stretches"))
            for placed, id_column in ((self._owed, "id_payment_document"), (self._paid, "id_payment_bundle"))
        )
        return match_positions(owed, paid, self.blocks)

    @cached_property
    def documents_after(self) -> DataFrame:
        line_ends = self.payments.groupBy(*AGREEMENT).agg(F.sum("total_amount").alias("line_end"))
        after = self._owed.join(line_ends, AGREEMENT, "left").withColumn("amount", _beyond_line_end())
        return after.select(*self.documents.columns)

    @cached_property
    def leftovers(self) -> DataFrame:
        line_ends = self.documents.groupBy(*AGREEMENT).agg(F.sum("amount").alias("line_end"))
        over = self._paid.join(line_ends, AGREEMENT, "left")
        over = over.select(*AGREEMENT, "id_payment_bundle", _beyond_line_end().alias("leftover"))
        return over.where(F.col("leftover") > 0)


def allocate_payments(documents: DataFrame, bundles: DataFrame, blocks: int | None = None) -> Allocation:
    """Settle documents by payments, oldest id first on both sides."""
    payments = bundles.select(
        "id_client",
        F.col("parent_cooperation_agreement_no").alias("cooperation_agreement_no"),
        "id_payment_bundle",
        "total_amount",
    )
    return Allocation(documents, payments, blocks)
