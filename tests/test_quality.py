"""Audits on injected faults, and the cascading purge."""

from __future__ import annotations

import datetime as dt

from legalops.model import TABLES
from legalops.operators import purge, quality
from tests.conftest import rows

D = dt.date


def broken(report):
    return {(r.table_name, r.rule): (r.failing_rows, r.sample_key) for r in report.collect() if r.failing_rows}


def test_every_rule_is_listed_even_for_empty_tables(tables):
    t = tables()
    assert quality.audit_keys(t).count() == 29
    assert quality.audit_orphans(t).count() == 23
    assert quality.audit_checks(t).count() == 16
    assert quality.audit_identifiers(t).count() == 10
    assert broken(quality.audit(t)) == {}


def test_keys(tables):
    t = tables(
        client_person=("id_client passport_data inn", [(1, "p", "i"), (1, "q", None), (2, "p", None), (3, "p", "k")]),
        outgoing_pay_document=(
            "payment_date account_no bik",
            [(D(2000, 1, 1), "a", "x"), (D(2000, 1, 1), "a", "x"), (D(2000, 1, 1), "a", "y")],
        ),
    )
    # NULL in a unique column is no repeat.
    assert broken(quality.audit_keys(t)) == {
        ("client_person", "primary key (id_client)"): (2, "1"),
        ("client_person", "unique (passport_data)"): (3, "p"),
        ("outgoing_pay_document", "primary key (payment_date, account_no, bik)"): (2, "2000-01-01|a|x"),
    }


def test_orphans(tables):
    t = tables(
        employee=("employee_number id_job_position account_no bik", [(1, 5, "a", "x"), (2, None, "a", None), (3, 5, "b", "x")]),
        bank_account=("account_no bik", [("a", "x")]),
        cooperation_agreement=(
            "id_client cooperation_agreement_no manager_number lawyer_number", [(9, 1, 1, 77), (9, 2, None, 77)],
        ),
    )
    # A reference with a NULL part passes.
    assert broken(quality.audit_orphans(t)) == {
        ("bank_account", "(bik) references bank"): (1, "x"),
        ("employee", "(id_job_position) references job_position"): (2, "5"),
        ("employee", "(account_no, bik) references bank_account"): (1, "b|x"),
        ("cooperation_agreement", "(id_client) references client"): (2, "9"),
        ("cooperation_agreement", "(lawyer_number) references employee"): (2, "77"),
    }


def test_checks_domains_and_nulls(tables):
    t = tables(
        employee=(
            "employee_number salary gender hire_date fire_date",
            [(1, -1, "M", D(2000, 1, 2), D(2000, 1, 1)), (2, None, "X", D(2000, 1, 2), None)],
        ),
        bank=("bik bank_name bank_cor_account", [("041234567", "a", "1"), ("141234567", "b", "2"), ("04123456", "c", "3")]),
    )
    # A check that comes to NULL passes.
    assert broken(quality.audit_checks(t)) == {
        ("bank", "bik_format"): (2, "04123456"),
        ("employee", "salary_not_negative"): (1, "1"),
        ("employee", "fired_after_hired"): (1, "1"),
        ("employee", "gender in domain"): (1, "2"),
    }
    nulls = broken(quality.audit_nulls(t))
    assert nulls["employee", "salary is required"] == (1, "2")
    assert nulls["employee", "account_no is required"] == (2, "1")
    assert ("employee", "fire_date is required") not in nulls


def test_identifiers(tables):
    t = tables(
        client_person=("id_client passport_data inn", [(1, "1234 567890", "123456789012"), (2, "1234567890", "1")]),
        client_legal=(
            "id_client inn ogrn",
            [(1, "1234567890", "123456789012" + str(123456789012 % 11 % 10)), (2, "1234567890", "123456789012" + str((123456789012 % 11 + 1) % 10)), (3, "1234567890", None)],
        ),
        client_entrepreneur=(
            "id_client inn ogrnip", [(1, "123456789012", "12345678901234" + str(12345678901234 % 13 % 10)), (2, "123456789012", "abc")],
        ),
    )
    assert broken(quality.audit_identifiers(t)) == {
        ("client_person", "passport_format"): (1, "2"),
        ("client_person", "inn_format"): (1, "2"),
        ("client_legal", "ogrn_check_digit"): (1, "2"),
        ("client_entrepreneur", "ogrnip_format"): (1, "2"),
    }


def test_purge_cascades_and_reports_blockers(spark, tables):
    t = tables(
        client=("id_client client_type", [(1, "LEGAL"), (2, "LEGAL"), (3, "PERSON")]),
        client_legal=("id_client company_name", [(1, "a"), (2, "b")]),
        cooperation_agreement=("id_client cooperation_agreement_no", [(1, 1), (3, 2)]),
    )
    done = purge.cascade_purge(t, "client", t["client"].where("id_client <= 2"))
    assert rows(done.tables["client"], "id_client") == [(3,)]
    assert done.tables["client_legal"].count() == 0
    assert rows(done.effects) == [
        ("client", "removed", 2), ("client_entrepreneur", "removed", 0), ("client_legal", "removed", 2),
        ("client_person", "removed", 0), ("cooperation_agreement", "blocking", 1),
    ]


def test_purge_goes_on_from_table_to_table_and_empties_references(tables):
    t = tables(
        bank=("bik", [("x",), ("y",)]),
        bank_account=("account_no bik", [("a", "x"), ("b", "y")]),
        job_position=("id_job_position", [(1,), (2,)]),
        employee=("employee_number account_no bik id_job_position", [(1, "b", "y", 1), (2, "b", "y", 2)]),
        outgoing_pay_document=(
            "payment_date account_no bik employee_number", [(D(2000, 1, 1), "a", "x", 1), (D(2000, 1, 1), "b", "y", 1)],
        ),
    )
    banks = purge.cascade_purge(t, "bank", t["bank"].where("bik = 'x'"))
    assert rows(banks.tables["bank_account"]) == [("b", "y")]
    assert rows(banks.tables["outgoing_pay_document"], "account_no") == [("b",)]
    assert ("employee", "blocking", 0) in rows(banks.effects)

    jobs = purge.cascade_purge(t, "job_position", t["job_position"].where("id_job_position = 1"))
    assert rows(jobs.tables["employee"], "employee_number", "id_job_position") == [(1, None), (2, 2)]
    assert jobs.tables["employee"].columns == t["employee"].columns
    assert ("employee", "emptied", 1) in rows(jobs.effects)


def test_purge_leaves_tables_it_does_not_reach(tables):
    t = tables(service=("id_service name_service", [(1, "a")]))
    done = purge.cascade_purge(t, "service", t["service"])
    assert set(done.tables) == set(TABLES)
    assert done.tables["client"] is t["client"]


def test_purge_by_a_repeated_key_removes_only_lines_of_the_service(tables):
    line = "id id_service assignment_agreement_no cooperation_agreement_no id_client price"
    t = tables(
        service=("id_service name_service price", [(1, "a", 1), (1, "a", 1), (2, "b", 1)]),
        contract_service=(line, [(7, 1, 1, 1, 1, 5), (7, 2, 1, 1, 1, 5), (7, 1, 1, 1, 1, 5), (8, None, 1, 1, 1, 5)]),
    )
    done = purge.cascade_purge(t, "service", t["service"].where("id_service = 1"))
    assert rows(done.tables["contract_service"], "id", "id_service") == [(7, 2), (8, None)]
    removed = {r["table_name"]: r["rows"] for r in done.effects.where("action = 'removed'").collect()}
    assert removed["contract_service"] == 2 and removed["service"] == 2


def test_a_row_held_back_by_two_references_blocks_once(tables):
    t = tables(
        employee=("employee_number fio", [(1, "a")]),
        cooperation_agreement=(
            "id_client cooperation_agreement_no manager_number lawyer_number", [(1, 1, 1, 1), (2, 2, 1, None), (3, 3, None, None)]
        ),
    )
    done = purge.cascade_purge(t, "employee", t["employee"])
    blocking = {r["table_name"]: r["rows"] for r in done.effects.where("action = 'blocking'").collect()}
    assert blocking == {"cooperation_agreement": 2}


def test_keys_that_only_look_alike_stay_apart(tables):
    t = tables(bank_account=("account_no bik", [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("d", "e"), ("d", "e")]))
    found = {(r["table_name"], r["rule"]): r for r in quality.audit_keys(t).collect()}
    keys = found["bank_account", "primary key (account_no, bik)"]
    assert (keys["failing_rows"], keys["sample_key"]) == (2, "d|e")
