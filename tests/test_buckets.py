"""Bucketed tables: the same rows, and plans without an exchange."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest

from legalops.sources import buckets
from tests.conftest import rows

DAY = dt.date(2000, 1, 1)


@pytest.fixture
def made(tables):
    cooperations = [(c, 10 * c + k, c % 3, DAY) for c in range(30) for k in range(2)]
    assignments = [(n, no, c, DAY + dt.timedelta(n)) for c, no, _, _ in cooperations for n in range(c % 4)]
    # A third of all lines belong to one agreement; one line has no agreement, one no client.
    lines = [(i, n, no, c, 5 + i % 7) for i, (n, no, c, _) in enumerate(assignments) for _ in range(1 + i % 3)]
    lines += [(9000 + i, 0, 50, 5, 1) for i in range(100)] + [(9500, 1, 77777, 5, 1), (9501, 1, 50, None, 1)]
    documents = [(no * 10 + n, n, no, c, 50) for n, no, c, _ in assignments]
    return tables(
        cooperation_agreement=("id_client cooperation_agreement_no manager_number start_date", cooperations),
        assignment_agreement=("assignment_agreement_no cooperation_agreement_no id_client created_at", assignments),
        contract_service=("id assignment_agreement_no cooperation_agreement_no id_client price", lines),
        payment_document=("id_payment_document assignment_agreement_no cooperation_agreement_no id_client amount", documents),
    )


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange"), plan.count("Sort ["), plan.count("SortMergeJoin")


def test_buckets_give_the_same_rows_without_an_exchange(spark, made, tmp_path):
    prefix = f"b{uuid.uuid4().hex[:8]}"
    buckets.write_buckets(made, str(tmp_path), prefix, 4)
    stored = buckets.read_buckets(spark, prefix)
    for name, table in stored.items():
        assert rows(table) == rows(made[name])
        assert len(list((tmp_path / name).glob("*.parquet"))) <= 4
    for report, joins in ((buckets.agreement_ledger, 2), (buckets.agreement_balances, 3)):
        assert rows(report(stored)) == rows(report(made))
        exchanges, _, merges = _exchanges(report(stored))
        assert (exchanges, merges) == (0, joins)
        assert _exchanges(report(made))[0] > 0


def test_another_session_names_the_buckets(spark, made, tmp_path):
    root, prefix = str(tmp_path / "root"), f"b{uuid.uuid4().hex[:8]}"
    buckets.write_buckets(made, root, prefix, 3)
    other = spark.newSession()
    again = f"{prefix}_again"
    buckets.attach_buckets(other, root, again, 3)
    buckets.attach_buckets(other, root, again, 3)
    named = buckets.read_buckets(other, again)
    assert rows(buckets.agreement_balances(named)) == rows(buckets.agreement_balances(made))
    assert _exchanges(buckets.agreement_balances(named))[0] == 0


def test_empty_tables_in_buckets(spark, tables, tmp_path):
    prefix = f"b{uuid.uuid4().hex[:8]}"
    buckets.write_buckets(tables(), str(tmp_path), prefix, 2)
    assert buckets.agreement_ledger(buckets.read_buckets(spark, prefix)).collect() == []
