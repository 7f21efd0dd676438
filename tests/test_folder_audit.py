"""Audits kept up by folder, against the whole audit."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from legalops.operators import folder_audit, quality
from legalops.sources import tables as source
from tests.conftest import rows

D = dt.date
NAME = "outgoing_pay_document"
PAID = "payment_date account_no bik employee_number amount payment_type result"


def _paid(tables, *payments):
    return tables(**{NAME: (PAID, list(payments))})[NAME]


def _whole(spark, root):
    t = {NAME: source.read_table(spark, root, NAME)}
    kept = folder_audit.kept_rules(NAME)
    return rows(quality.audit_rows(t).unionByName(quality.audit_keys(t)).where(quality.F.col("rule").isin(kept)))


def test_an_append_is_audited_by_its_folders_alone(spark, tables, tmp_path):
    root, kept = str(tmp_path / "t"), str(tmp_path / "summaries")
    assert rows(folder_audit.audit_by_folder(spark, root, NAME, kept), "failing_rows") == [(0,)] * len(folder_audit.kept_rules(NAME))
    first = [(D(2001, 1, d), "a" * 20, "044000000", 1, d, "ADVANCE", None) for d in range(1, 6)]
    first += [(D(2001, 1, 1), "a" * 20, "044000000", 1, 7, "PAYMENT", None), (None, "b", "x", 1, -1, "ADVANCE", None)]
    source.append_rows(_paid(tables, *first, (D(2001, 2, 1), None, "x", 1, -5, "BONUS", None)), root, NAME)
    found = folder_audit.audit_by_folder(spark, root, NAME, kept)
    assert rows(found) == _whole(spark, root)
    assert dict(rows(found.where("failing_rows > 0"), "rule", "failing_rows"))["primary key (payment_date, account_no, bik)"] == 2
    assert folder_audit.audit_changed_folders(spark, root, NAME, kept) == []

    # A folder that is not read: its file is spoilt, but looks as before.
    month = tmp_path / "t" / NAME / "month=2001-01-01"
    spoilt = next(f for f in month.rglob("*.parquet"))
    held, times = spoilt.read_bytes(), os.stat(spoilt)
    spoilt.write_bytes(b"x" * len(held))
    os.utime(spoilt, ns=(times.st_atime_ns, times.st_mtime_ns))
    source.append_rows(_paid(tables, (D(2001, 2, 9), "c", "x", None, -7, "ADVANCE", None), (D(2001, 3, 9), "c", None, 1, 7, "ADVANCE", None)), root, NAME)
    assert folder_audit.audit_changed_folders(spark, root, NAME, kept) == ["2001-02-01", "2001-03-01"]
    found = rows(folder_audit.audit_by_folder(spark, root, NAME, kept))
    spoilt.write_bytes(held)
    os.utime(spoilt, ns=(times.st_atime_ns, times.st_mtime_ns))
    spark.catalog.refreshByPath(f"{root}/{NAME}")
    assert found == _whole(spark, root)

    # Folders written again, and folders that go.
    source.replace_months(_paid(tables, (D(2001, 2, 1), "d", "x", 1, 5, "BONUS", None)), root, NAME)
    assert rows(folder_audit.audit_by_folder(spark, root, NAME, kept)) == _whole(spark, root)
    for f in (tmp_path / "t" / NAME / "month=2001-03-01").rglob("*"):
        if f.is_file():
            f.unlink()
    spark.catalog.refreshByPath(f"{root}/{NAME}")
    assert rows(folder_audit.audit_by_folder(spark, root, NAME, kept)) == _whole(spark, root)
    with pytest.raises(ValueError):
        folder_audit.audit_by_folder(spark, root, "client", kept)
