"""Billing: what agreements cost, as documents, bundles and incoming payments."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.functions.scans import null_safe_join
from legalops.model import ASSIGNMENT_KEY
from legalops.sources.tables import Tables, update_rows


class Bills(NamedTuple):
    payment_document: DataFrame
    payment_bundle: DataFrame
    income_pay_document: DataFrame
    income_payment_bundle: DataFrame


def assignment_amounts(t: Tables) -> DataFrame:
    """Every assignment with the sum of its line prices, 0 if it has none."""
    sums = t["contract_service"].groupBy(*ASSIGNMENT_KEY).agg(F.sum("price").alias("amount"))
    assignments = t["assignment_agreement"].select(*ASSIGNMENT_KEY, "created_at")
    return assignments.join(sums, list(ASSIGNMENT_KEY), "left").withColumn(
        "amount", F.coalesce("amount", F.lit(0))
    )


def bill_agreements(
    t: Tables, document_id: Column, account_no: Column, bik: Column, delay_days: int = 10
) -> Bills:
    """A document per assignment and a bundle per client and day, paid in full.

    `document_id` makes a unique id from the assignment's key columns; a bundle
    takes the smallest id of its documents and the smallest of its agreements.
    Assignments without a client or a day are billed too, together where both agree.
    `account_no` and `bik` name the paying account from the bundle's columns.
    """
    amounts = assignment_amounts(t).withColumn("id_payment_document", document_id)
    day_of_client = ["id_client", "created_at"]
    bundles = amounts.groupBy(*day_of_client).agg(
        F.min("id_payment_document").alias("id_payment_bundle"),
        F.min("cooperation_agreement_no").alias("parent_cooperation_agreement_no"),
        F.sum("amount").alias("total_amount"),
    )
    documents = null_safe_join(amounts, bundles.select(*day_of_client, "id_payment_bundle"), day_of_client)
    incomes = bundles.select(
        F.col("id_payment_bundle").alias("id_income_pay_document"),
        account_no.alias("account_no"),
        bik.alias("bik"),
        F.col("total_amount").alias("amount"),
        F.date_add("created_at", delay_days).alias("payment_date"),
    )
    return Bills(
        documents.select("id_payment_document", "id_payment_bundle", *ASSIGNMENT_KEY, "amount"),
        bundles.select(
            "id_payment_bundle", "parent_cooperation_agreement_no", "id_client", "total_amount", "created_at"
        ),
        incomes,
        bundles.select(F.col("id_payment_bundle").alias("id_income_pay_document"), "id_payment_bundle"),
    )


def update_bundle_totals(bundles: DataFrame, documents: DataFrame) -> DataFrame:
    """Bundles with their total set to what their documents add up to."""
    totals = (
        documents.where(F.col("id_payment_bundle").isNotNull())
        .groupBy("id_payment_bundle")
        .agg(F.sum("amount").alias("total_amount"))
    )
    return update_rows(bundles, totals, ["id_payment_bundle"], ["total_amount"])
