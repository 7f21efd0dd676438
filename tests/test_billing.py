"""Billing, and its bundle totals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from legalops.operators.billing import bill_agreements, update_bundle_totals
from tests.conftest import rows

D = dt.date


def bills(tables):
    t = tables(
        assignment_agreement=(
            "assignment_agreement_no cooperation_agreement_no id_client created_at",
            [
                (1, 20, 5, D(2000, 1, 1)), (1, 10, 5, D(2000, 1, 1)), (2, 10, 5, D(2000, 1, 2)),
                (1, 30, 6, D(2000, 1, 1)),
            ],
        ),
        contract_service=(
            "id assignment_agreement_no cooperation_agreement_no id_client price",
            [(1, 1, 20, 5, 100), (2, 1, 20, 5, 30), (3, 1, 10, 5, 7), (4, 1, 30, 6, 1)],
        ),
    )
    number = F.col("cooperation_agreement_no") * 10 + F.col("assignment_agreement_no")
    return bill_agreements(t, number, F.col("id_client").cast("string"), F.lit("bank"), delay_days=10)


def test_bills(tables):
    made = bills(tables)
    # Agreements of one client and day share a bundle; one without lines owes 0.
    assert rows(made.payment_document, "id_payment_document", "id_payment_bundle", "amount") == [
        (101, 101, 7), (102, 102, 0), (201, 101, 130), (301, 301, 1),
    ]
    assert rows(made.payment_bundle) == [
        (101, 10, 5, 137, D(2000, 1, 1)), (102, 10, 5, 0, D(2000, 1, 2)), (301, 30, 6, 1, D(2000, 1, 1)),
    ]
    assert rows(made.income_pay_document)[0] == (101, "5", "bank", 137, D(2000, 1, 11))
    assert rows(made.income_payment_bundle) == [(101, 101), (102, 102), (301, 301)]


def test_update_bundle_totals(tables):
    made = bills(tables)
    unset = made.payment_bundle.withColumn("total_amount", F.lit(-1).cast("long"))
    updated = update_bundle_totals(unset, made.payment_document.where("id_payment_bundle <> 301"))
    # A bundle without documents keeps what it had.
    assert rows(updated, "id_payment_bundle", "total_amount") == [(101, 137), (102, 0), (301, -1)]


def test_assignments_without_a_client_or_day_are_billed(tables):
    t = tables(
        assignment_agreement=(
            "assignment_agreement_no cooperation_agreement_no id_client created_at",
            [(1, 10, None, D(2000, 1, 1)), (2, 10, None, D(2000, 1, 1)), (1, 20, 5, None), (1, 30, 5, D(2000, 1, 1))],
        ),
        contract_service=("id assignment_agreement_no cooperation_agreement_no id_client price", [(1, 1, 20, 5, 8), (2, 1, 30, 5, 9)]),
    )
    number = F.col("cooperation_agreement_no") * 10 + F.col("assignment_agreement_no")
    made = bill_agreements(t, number, F.col("id_client").cast("string"), F.lit("bank"))
    assert rows(made.payment_document, "id_payment_document", "id_payment_bundle", "amount") == [
        (101, 101, 0), (102, 101, 0), (201, 201, 8), (301, 301, 9),
    ]
    assert rows(made.payment_bundle, "id_payment_bundle", "total_amount") == [(101, 0), (201, 8), (301, 9)]
