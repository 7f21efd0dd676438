"""Versions that readers follow, updates in place, and purges published at once."""

from __future__ import annotations

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from legalops.operators.purge import cascade_purge, write_purge
from legalops.sources import tables as source
from legalops.sources import versions
from tests.conftest import rows

D = dt.date
PAID = "payment_date account_no bik employee_number amount payment_type result"


def _service(tables, *ids):
    return tables(service=("id_service name_service price", [(i, f"s{i}", i) for i in ids]))["service"]


def test_versions_replace_tables_together(spark, tables, tmp_path):
    root = str(tmp_path)
    assert versions.folders(spark, root) == {} and versions.read_current(spark, root) == {}
    t = tables(
        service=("id_service name_service price", [(1, "a", 1), (2, "b", 2)]),
        outgoing_pay_document=(PAID, [(D(2001, 1, 5), "a", "x", 1, 1, "ADVANCE", None), (None, "b", "x", 1, 2, "PAYMENT", True)]),
    )
    assert versions.replace_tables({n: t[n] for n in ("service", "outgoing_pay_document")}, root) == 1
    first = versions.read_current(spark, root)
    assert rows(first["outgoing_pay_document"], "month", "amount") == [(D(2001, 1, 1), 1), (None, 2)]
    # A load may read what it replaces, and the other tables stay.
    assert versions.replace_tables({"service": first["service"].where("id_service = 2")}, root) == 2
    now = versions.read_current(spark, root)
    assert rows(now["service"], "id_service") == [(2,)] and now["outgoing_pay_document"].count() == 2
    assert rows(first["service"], "id_service") == [(1,), (2,)]  # an earlier reader goes on
    assert rows(versions.read_current(spark, root, 1)["service"], "id_service") == [(1,), (2,)]
    assert len(versions.expire(spark, root, keep=1)) == 1
    assert rows(versions.read_current(spark, root)["service"], "id_service") == [(2,)]
    with pytest.raises(ValueError):
        versions.replace_tables({}, root)


def test_a_failed_load_and_a_second_load_leave_the_version(spark, tables, tmp_path):
    root = str(tmp_path)
    versions.replace_tables({"service": _service(tables, 1)}, root)
    broken = _service(tables, 2).withColumn("price", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        versions.replace_tables({"service": broken}, root)
    assert rows(versions.read_current(spark, root)["service"], "id_service") == [(1,)]
    since = versions.current_version(spark, root)
    versions.replace_tables({"service": _service(tables, 3)}, root, since)
    with pytest.raises(versions.Conflict):
        versions.replace_tables({"service": _service(tables, 4)}, root, since)
    # A load that died between claim and publication holds the number until it is given back.
    (tmp_path / versions.VERSIONS / f"{since + 2:012d}.claim").touch()
    with pytest.raises(versions.Conflict):
        versions.replace_tables({"service": _service(tables, 5)}, root)
    versions.abandon_claim(spark, root)
    versions.replace_tables({"service": _service(tables, 6)}, root)
    assert rows(versions.read_current(spark, root)["service"], "id_service") == [(6,)]


def test_readers_never_miss_a_table_while_it_is_reloaded(spark, tables, tmp_path):
    root, seen, failed, done = str(tmp_path), set(), [], threading.Event()
    versions.replace_tables({"service": _service(tables, *range(1))}, root)

    def read():
        while not done.is_set():
            try:
                found = versions.read_current(spark, root)["service"].select("id_service").collect()
                seen.add(len(found))
            except Exception as e:  # noqa: BLE001
                failed.append(e)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 9):
        versions.replace_tables({"service": _service(tables, *range(n))}, root)
    done.set()
    reader.join()
    assert not failed and len(seen) > 1


def _files(root, name):
    return {os.path.join(at, f) for at, _, files in os.walk(os.path.join(root, name)) for f in files if f.endswith(".parquet")}


def test_an_update_writes_only_the_folders_it_touches(spark, tables, tmp_path):
    root, name = str(tmp_path), "outgoing_pay_document"
    paid = [(D(2001, m, d), f"a{d}", "x", d, 10 * m + d, kind, None) for m in (1, 2, 3) for d, kind in ((1, "ADVANCE"), (2, "ADVANCE"), (9, "PAYMENT"))]
    source.append_rows(tables(outgoing_pay_document=(PAID, paid))[name], root, name)
    before = _files(root, name)
    keys, schema = ["payment_date", "account_no", "bik"], "payment_date date, account_no string, bik string, amount long, result boolean"
    updates = [(D(2001, 2, 1), "a1", "x", 777, True), (D(2001, 3, 9), "a9", "x", None, False), (D(2001, 3, 5), "none", "x", 1, True), (D(1999, 1, 1), "a1", "x", 1, True), (None, "a1", "x", 1, True)]
    months = source.update_in_place(spark, root, name, spark.createDataFrame(updates, schema), keys, ["amount", "result"])
    assert months == [D(2001, 2, 1), D(2001, 3, 1)]
    want = {(p[0], p[1]): (p[4], p[6]) for p in paid} | {(D(2001, 2, 1), "a1"): (777, True), (D(2001, 3, 9), "a9"): (39, False)}
    stored = source.read_table(spark, root, name)
    assert {(r["payment_date"], r["account_no"]): (r["amount"], r["result"]) for r in stored.collect()} == want
    touched = ("month=2001-02-01/payment_type=ADVANCE", "month=2001-03-01/payment_type=PAYMENT")
    gone = before - _files(root, name)
    assert gone and all(any(part in f for part in touched) for f in gone)
    assert {f for f in before if not any(part in f for part in touched)} <= _files(root, name)

    # Keys without the date: the months are found by a scan of the keys.
    by_account = spark.createDataFrame([("a9", 5)], "account_no string, amount long")
    assert source.update_in_place(spark, root, name, by_account, ["account_no"], ["amount"]) == [D(2001, m, 1) for m in (1, 2, 3)]
    assert {r["amount"] for r in source.read_table(spark, root, name).where("account_no = 'a9'").collect()} == {5}
    assert source.update_in_place(spark, root, name, by_account.where("false"), ["account_no"], ["amount"]) == []
    with pytest.raises(ValueError):
        source.update_in_place(spark, root, name, by_account, ["account_no"], ["payment_type"])


def _chain(tables):
    return tables(
        client=("id_client client_type", [(k, "PERSON") for k in range(6)]),
        client_person=("id_client fio", [(k, "p") for k in range(6)]),
        service=("id_service name_service price", [(1, "a", 1), (2, "b", 2), (2, "b", 2)]),
        price_list=("creation_date", [(D(2000, 1, 1),)]),
        price_list_service=("id_service creation_date client_type price", [(s, D(2000, 1, 1), "PERSON", 1) for s in (1, 2)]),
        contract_service=("id id_service price", [(i, 1 + i % 2, 1) for i in range(7)] + [(9, None, 1)]),
        cooperation_agreement=("id_client cooperation_agreement_no", [(5, 50)]),
    )


def test_purge_keeps_its_books_and_its_plans_small(spark, tables):
    t = _chain(tables)
    purge = cascade_purge(t, "service", t["service"].where("id_service = 2"))
    removed = {r["table_name"]: r["rows"] for r in purge.effects.where("action = 'removed'").collect()}
    assert removed == {"service": 2, "price_list_service": 1, "contract_service": 3}
    for name, n in removed.items():
        assert t[name].count() == purge.tables[name].count() + n
    # The children read the written keys, not the plan that found them.
    plan = purge.tables["contract_service"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_a_purge_is_published_at_once_or_not_at_all(spark, tables, tmp_path):
    root, t = str(tmp_path), _chain(tables)
    versions.replace_tables(t, root)
    with pytest.raises(ValueError, match="cooperation_agreement"):
        write_purge(spark, root, "client", t["client"].where("id_client >= 4"))
    assert versions.current_version(spark, root) == 1
    untouched = versions.folders(spark, root)["service"]
    write_purge(spark, root, "client", t["client"].where("id_client < 2"))
    now = versions.read_current(spark, root)
    assert versions.current_version(spark, root) == 2 and versions.folders(spark, root)["service"] == untouched
    assert rows(now["client"], "id_client") == rows(now["client_person"], "id_client") == [(2,), (3,), (4,), (5,)]
    write_purge(spark, root, "client", t["client"].where("id_client = 99"))
    assert versions.current_version(spark, root) == 2
