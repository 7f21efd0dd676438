"""Reports on hand-made rows, one case per point where a report might go wrong."""

from __future__ import annotations

import datetime as dt

from legalops.plans import reports
from tests.conftest import rows

D = dt.date

CLIENTS = ("id_client client_type", [(1, "PERSON"), (2, "LEGAL"), (3, "ENTREPRENEUR"), (4, "PERSON")])
PERSONS = ("id_client fio", [(1, "Ann"), (4, "Dan"), (3, "Other name")])
COMPANIES = ("id_client company_name", [(2, "Beta")])
ENTREPRENEURS = ("id_client fio", [(3, "Cyd")])
COOPERATIONS = (
    "id_client cooperation_agreement_no start_date manager_number",
    [(1, 10, D(2000, 1, 5), 7), (1, 11, D(2000, 1, 9), 7), (2, 20, D(2000, 2, 1), None), (3, 30, D(2000, 3, 1), 8)],
)
# Numbers restart in every cooperation; 11 is a cooperation without assignments.
ASSIGNMENTS = (
    "assignment_agreement_no cooperation_agreement_no id_client created_at completion_date",
    [
        (1, 10, 1, D(2000, 1, 6), D(2000, 5, 1)),
        (2, 10, 1, D(2000, 4, 1), None),
        (1, 20, 2, D(2000, 2, 2), None),
        (1, 30, 3, D(2000, 3, 2), None),
    ],
)
SERVICES = ("id_service name_service price", [(1, "zoning", 5), (2, "advice", 5), (3, "unused", 5)])
LINES = (
    "id id_service assignment_agreement_no cooperation_agreement_no id_client price",
    [
        (1, 1, 1, 10, 1, 100),
        (2, 1, 1, 10, 1, 100),
        (3, 2, 1, 10, 1, 70),
        (4, 2, 2, 10, 1, 70),
        (5, 1, 1, 20, 2, 100),
        (6, 2, 1, 30, 3, 70),
    ],
)
BUNDLES = (
    "id_payment_bundle parent_cooperation_agreement_no id_client total_amount created_at",
    [(1, 10, 1, 50, D(2000, 2, 1)), (2, 10, 1, 60, D(2000, 2, 1)), (3, 30, 3, 90, D(2000, 4, 1))],
)
LINKS = ("id_income_pay_document id_payment_bundle", [(101, 1), (102, 2), (103, 3)])
# Client 1 pays from two accounts on one day.
INCOMES = (
    "id_income_pay_document account_no bik amount payment_date",
    [(101, "B", "x", 50, D(2000, 3, 1)), (102, "A", "x", 60, D(2000, 3, 1)), (103, "C", "x", 90, D(2000, 4, 9))],
)


def business(tables, **more):
    given = dict(
        client=CLIENTS, client_person=PERSONS, client_legal=COMPANIES, client_entrepreneur=ENTREPRENEURS,
        cooperation_agreement=COOPERATIONS, assignment_agreement=ASSIGNMENTS, service=SERVICES,
        contract_service=LINES, payment_bundle=BUNDLES, income_payment_bundle=LINKS, income_pay_document=INCOMES,
    )
    return tables(**{**given, **more})


def test_client_statistics(tables):
    report = reports.client_statistics(business(tables)).drop("created_at").collect()
    assert [tuple(r) for r in report] == [
        # Two assignments and a bare cooperation share four lines: 4/3 rounds to 1.
        # "advice" and "zoning" tie at two lines and the name decides.
        ("Ann", 1, 2, 4, 1.0, D(2000, 4, 1), D(2000, 5, 1), "advice", "A,B"),
        ("Beta", 2, 1, 1, 1.0, D(2000, 2, 2), None, "zoning", None),
        # In two subtables: the entrepreneur's name comes first.
        ("Cyd", 3, 1, 1, 1.0, D(2000, 3, 2), None, "advice", "C"),
        ("Dan", 4, 0, 0, 0.0, None, None, None, None),
    ]


def test_lines_of_an_unknown_service_count_but_have_no_name(tables):
    lines = (LINES[0], LINES[1] + [(7 + i, 99, 2, 10, 1, 1) for i in range(5)])
    ann = [r for r in reports.client_statistics(business(tables, contract_service=lines)).collect() if r.name == "Ann"][0]
    assert (ann.services, ann.top_service) == (9, "advice")


def test_average_rounds_half_up(tables):
    lines = (LINES[0], LINES[1] + [(7, 1, 2, 10, 1, 1)])
    t = business(tables, contract_service=lines, cooperation_agreement=(COOPERATIONS[0], COOPERATIONS[1][:1]))
    ann = [r for r in reports.client_statistics(t).collect() if r.name == "Ann"][0]
    assert (ann.agreements, ann.services, ann.avg_services_per_agreement) == (2, 5, 3.0)


def test_debtors(tables):
    report = rows(reports.debtors(business(tables)))
    assert report == [
        # Charged 340 and paid 110: services and payments do not multiply each other.
        ("Ann", 1, 2, 340, 110, D(2000, 4, 1), D(2000, 3, 1), "A", 230),
        # Never paid, and so not dropped. Client 3 overpaid and is no debtor.
        ("Beta", 2, 1, 100, 0, D(2000, 2, 2), None, None, 100),
    ]


def test_service_popularity(tables):
    prices = (
        "id_service creation_date price client_type",
        [
            (1, D(2000, 1, 1), 10, "LEGAL"), (1, D(2000, 4, 1), 12, "LEGAL"), (1, D(2000, 1, 1), 9, "PERSON"),
            (2, D(2000, 1, 1), 7, "LEGAL"), (3, D(2000, 1, 1), 7, "LEGAL"),
        ],
    )
    lists = ("creation_date", [(D(2000, 1, 1),), (D(2000, 4, 1),)])
    t = business(tables, price_list_service=prices, price_list=lists)
    # "advice" is in three agreements, "zoning" twice in one and once in another: 1.5
    # rounds to 2. Agreements are told apart by their whole key. "unused" is left out.
    assert [tuple(r) for r in reports.service_popularity(t).collect()] == [
        ("advice", 3, 1.0, "LEGAL", 7, 7),
        ("zoning", 2, 2.0, "LEGAL", 12, 10),
        ("zoning", 2, 2.0, "PERSON", 9, 9),
    ]
    wide = reports.service_popularity_wide(t)
    assert wide.columns[3:] == [
        "max_person", "min_person", "max_entrepreneur", "min_entrepreneur", "max_legal", "min_legal",
    ]
    assert [tuple(r) for r in wide.collect()] == [
        ("advice", 3, 1.0, None, None, None, None, 7, 7),
        ("zoning", 2, 2.0, 9, 9, None, None, 12, 10),
    ]
    current = reports.service_popularity_current(t, D(2000, 3, 31)).collect()
    assert ("zoning", 2, 2.0, "LEGAL", 10) in [tuple(r) for r in current]
    later = reports.service_popularity_current(t, D(2000, 4, 1)).collect()
    assert [tuple(r) for r in later] == [("zoning", 2, 2.0, "LEGAL", 12)]


def signed(tables, *signed_on):
    cooperations = [(1, i, day, manager) for i, (day, manager) in enumerate(signed_on)]
    return tables(
        cooperation_agreement=(COOPERATIONS[0], cooperations),
        employee=("employee_number fio", [(7, "Max"), (8, "Nia")]),
    )


def test_manager_monthly(tables):
    t = signed(
        tables,
        (D(1999, 12, 31), 7),  # before the year
        (D(2000, 1, 1), 7), (D(2000, 3, 1), 7), (D(2000, 3, 2), 7), (D(2000, 3, 31), 7), (D(2000, 4, 1), 7),
        (D(2000, 12, 31), None),
        (D(2001, 1, 1), 7),  # after it
    )
    max_, nobody = reports.manager_monthly(t, D(2001, 6, 30)).collect()
    assert (max_.manager_number, nobody.manager_number) == (7, None)
    assert (max_.january_amount, max_.january_relative) == (1, 0)
    # March has the gap month before it skipped: from 1 to 3 is 200 %.
    assert (max_.march_amount, max_.march_relative) == (3, 200)
    # From 3 to 1 is -66 %, of which the whole division leaves 0.
    assert (max_.april_amount, max_.april_relative) == (1, 0)
    assert (max_.february_amount, max_.february_relative) == (0, 0)
    assert (nobody.december_amount, nobody.december_relative) == (1, 0)
    assert len(reports.manager_monthly(t, D(2001, 6, 30)).columns) == 25


def test_manager_monthly_calendar(tables):
    t = signed(
        tables,
        (D(1999, 12, 31), 7), (D(1999, 12, 1), 7), (D(2000, 1, 1), 7), (D(2000, 3, 1), 7), (D(2000, 5, 1), None),
    )
    max_, nia = reports.manager_monthly_calendar(t, D(2001, 6, 30)).collect()
    assert (max_.january_amount, max_.january_relative) == (1, -50.0)
    assert (max_.february_amount, max_.february_relative) == (0, -100.0)
    assert (max_.march_amount, max_.march_relative) == (1, None)
    # An employee who signed nothing has a row; agreements without a manager have none.
    assert (nia.fio, nia.may_amount, nia.may_relative) == ("Nia", 0, None)


def test_payroll_year(tables):
    t = tables(
        employee=("employee_number fio", [(7, "Max"), (8, "Nia")]),
        outgoing_pay_document=(
            "payment_date account_no bik employee_number amount payment_type result",
            [
                (D(2000, 12, 31), "a", "x", 7, 1, "ADVANCE", False),
                (D(2001, 1, 1), "a", "x", 7, 10, "ADVANCE", True),
                (D(2001, 2, 1), "a", "x", 7, 20, "PAYMENT", None),
                (D(2001, 3, 1), "a", "x", 7, 40, "PAYMENT", False),
                (D(2001, 4, 1), "a", "x", 7, 80, "ADVANCE", False),
                (D(2001, 6, 30), "a", "x", 7, 160, "ADVANCE", False),
            ],
        ),
    )
    as_of = D(2001, 6, 30)
    assert rows(reports.payroll_year(t, as_of)) == [(7, "Max", 2, 2, 10, 120, D(2001, 3, 1))]
    assert rows(reports.payroll_year(t, as_of, null_is_owed=True)) == [(7, "Max", 2, 2, 10, 140, D(2001, 2, 1))]
