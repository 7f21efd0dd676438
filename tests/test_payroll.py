"""Payroll runs and schedules."""

from __future__ import annotations

import datetime as dt

import pytest

from legalops.operators.payroll import payroll_run, payroll_schedule, post_payroll_run
from legalops.sources.tables import read_table
from tests.conftest import rows

D = dt.date
STAFF = "employee_number account_no bik hire_date fire_date salary"
PAID = "payment_date account_no bik employee_number amount payment_type"
EVERYONE = [
    (1, "a", "x", D(2001, 1, 15), None, 50000),
    (2, "b", "x", D(2001, 1, 15), None, 12000),
    (3, "c", "x", D(2001, 1, 15), D(2001, 2, 1), 50000),
]


def staff(tables, paid=(), people=EVERYONE):
    return tables(employee=(STAFF, people), outgoing_pay_document=(PAID, list(paid)))


def test_advance_run(tables):
    run = payroll_run(staff(tables), "ADVANCE", D(2001, 3, 20), payment_month=D(1999, 1, 1))
    assert rows(run.rows) == [
        (D(2001, 3, 20), "a", "x", 1, 15000, "ADVANCE", None),
        (D(2001, 3, 20), "b", "x", 2, 15000, "ADVANCE", None),
    ]
    assert rows(run.total) == [("ADVANCE", 2, 30000)]


def test_payment_run(tables):
    t = staff(tables)
    run = payroll_run(t, "PAYMENT", D(2001, 3, 20))
    assert rows(run.rows, "payment_date", "employee_number", "amount") == [
        (D(2001, 2, 28), 1, 35000), (D(2001, 2, 28), 2, 0),
    ]
    inside = payroll_run(t, "PAYMENT", D(2001, 3, 20), payment_month=D(2001, 2, 10))
    assert {r.payment_date for r in inside.rows.collect()} == {D(2001, 2, 9)}


def test_run_refuses_unknown_kinds_and_taken_months(tables):
    with pytest.raises(ValueError, match="unknown"):
        payroll_run(staff(tables), "BONUS", D(2001, 3, 20))
    t = staff(tables, [(D(2001, 3, 1), "z", "x", 9, 1, "ADVANCE")])
    with pytest.raises(ValueError, match="exist already"):
        payroll_run(t, "ADVANCE", D(2001, 3, 20))
    # The other kind, and other months, are free.
    assert payroll_run(t, "PAYMENT", D(2001, 4, 5)).rows.count() == 2
    assert payroll_run(t, "ADVANCE", D(2001, 4, 1)).rows.count() == 2


def test_run_refuses_taken_keys(tables):
    t = staff(tables, [(D(2001, 2, 28), "a", "x", 1, 1, "ADVANCE")])
    with pytest.raises(ValueError, match="already paid"):
        payroll_run(t, "PAYMENT", D(2001, 3, 20))
    shared = [(1, "a", "x", D(2001, 1, 1), None, 1), (2, "a", "x", D(2001, 1, 1), None, 1)]
    with pytest.raises(ValueError, match="share"):
        payroll_run(staff(tables, people=shared), "ADVANCE", D(2001, 3, 20))


def test_run_of_no_staff(tables):
    assert rows(payroll_run(staff(tables, people=[]), "ADVANCE", D(2001, 3, 20)).total) == [("ADVANCE", 0, 0)]


def plan(people, as_of):
    """The schedule by a plain loop over months."""

    def workday(d):
        while d.weekday() >= 5 or (d.month == 1 and d.day <= 14):
            d -= dt.timedelta(days=1)
        return d

    out = []
    for number, account, bank, hired, fired, salary in people:
        month = hired.replace(day=1)
        while month <= as_of and (fired is None or month <= fired):
            after = (month + dt.timedelta(days=31)).replace(day=1)
            out.append((workday(month.replace(day=25)), number, min(15000, salary), "ADVANCE"))
            if salary > 15000:
                out.append((workday(after.replace(day=10)), number, salary - 15000, "PAYMENT"))
            month = after
    return sorted(out)


def test_schedule_matches_a_loop(tables):
    people = EVERYONE + [
        (4, "d", "x", D(1998, 12, 31), None, 15000),
        (5, "e", "x", D(1996, 2, 29), D(2001, 12, 31), 15001),
        (6, "f", "x", D(2002, 1, 1), None, 99999),  # hired after
    ]
    as_of = D(2001, 6, 30)
    t = staff(tables, people=people)
    got = payroll_schedule(t["employee"], as_of)
    assert sorted(tuple(r) for r in got.select("payment_date", "employee_number", "amount", "payment_type").collect()) == plan(people, as_of)
    assert got.columns == t["outgoing_pay_document"].columns


def test_a_posted_run_is_checked_and_stored_once(spark, tables, tmp_path):
    root, people = str(tmp_path), staff(tables)["employee"]
    assert rows(post_payroll_run(people, root, "ADVANCE", D(2001, 3, 20))) == [("ADVANCE", 2, 30000)]
    post_payroll_run(people, root, "PAYMENT", D(2001, 3, 20), D(2001, 4, 1))
    stored = lambda: rows(read_table(spark, root, "outgoing_pay_document"), "payment_type", "amount")
    want = [("ADVANCE", 15000), ("ADVANCE", 15000), ("PAYMENT", 0), ("PAYMENT", 35000)]
    assert stored() == want
    with pytest.raises(ValueError, match="claimed"):
        post_payroll_run(people, root, "ADVANCE", D(2001, 3, 5))
    # Without a claim the guards still look, and the claim is given back.
    for claim in (tmp_path / "_payroll").iterdir():
        claim.unlink()
    with pytest.raises(ValueError, match="exist already"):
        post_payroll_run(people, root, "ADVANCE", D(2001, 3, 5))
    with pytest.raises(ValueError, match="unknown"):
        post_payroll_run(people, root, "BONUS", D(2001, 3, 5))
    post_payroll_run(people, root, "ADVANCE", D(2001, 5, 5))
    assert len(stored()) == 6
    assert sorted(p.name for p in (tmp_path / "_payroll").iterdir() if not p.name.startswith(".")) == ["2001-05-01-ADVANCE"]
