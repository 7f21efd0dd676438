"""Reading, writing and changing stored tables."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from legalops.model import TABLES
from legalops.operators import payroll
from legalops.plans import reports
from legalops.session import drop_staged, shared_folder
from legalops.sources import tables as source
from legalops.sources.star import StarTables
from legalops.streaming.sink import append
from tests.conftest import rows

D = dt.date
PAID = "payment_date account_no bik employee_number amount payment_type result"


def paid(tables, *payments):
    return tables(outgoing_pay_document=(PAID, list(payments)))["outgoing_pay_document"]


def test_reload_append_and_replace_months(tables, spark, tmp_path):
    root, name = str(tmp_path), "outgoing_pay_document"
    source.reload_table(paid(tables, (D(1999, 1, 1), "z", "x", 9, 1, "ADVANCE", None)), root, name)
    source.reload_table(paid(tables, (D(2001, 1, 5), "a", "x", 1, 1, "ADVANCE", None)), root, name)
    source.append_rows(paid(tables, (D(2001, 1, 9), "b", "x", 2, 2, "ADVANCE", None), (D(2001, 2, 1), "a", "x", 1, 3, "ADVANCE", None)), root, name)
    stored = source.read_table(spark, root, name)
    assert rows(stored, "month", "amount") == [(D(2001, 1, 1), 1), (D(2001, 1, 1), 2), (D(2001, 2, 1), 3)]

    # The same months twice over is as good as once.
    for _ in range(2):
        source.replace_months(paid(tables, (D(2001, 1, 7), "c", "x", 3, 7, "ADVANCE", None)), root, name)
    assert rows(source.read_table(spark, root, name), "month", "amount") == [(D(2001, 1, 1), 7), (D(2001, 2, 1), 3)]


def test_reload_from_the_table_itself_and_a_failed_load(tables, spark, tmp_path):
    root, name = str(tmp_path), "outgoing_pay_document"
    source.reload_table(paid(tables, *[(D(2001, m, 5), "a", "x", 1, m, "ADVANCE", None) for m in (1, 2, 3)]), root, name)
    source.reload_table(source.read_table(spark, root, name).where("amount > 1"), root, name)
    assert rows(source.read_table(spark, root, name), "amount") == [(2,), (3,)]
    assert os.listdir(root) == [name]

    broken = source.read_table(spark, root, name).withColumn("amount", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        source.reload_table(broken, root, name)
    assert rows(source.read_table(spark, root, name), "amount") == [(2,), (3,)]


def test_current_prices_read_one_list(spark, tmp_path):
    views = StarTables(spark, "/root/testdata/sf0.001")
    source.reload_tables(views, str(tmp_path))
    stored = source.read_tables(spark, str(tmp_path))
    report = reports.service_popularity_current(stored, D(2001, 6, 30))
    assert rows(report) == rows(reports.service_popularity_current(views, D(2001, 6, 30)))
    assert "PartitionFilters: [isnotnull(month" in report._jdf.queryExecution().executedPlan().toString()


def test_writing_one_kind_again_keeps_the_other(tables, spark, tmp_path):
    root, name = str(tmp_path), "outgoing_pay_document"
    advance = paid(tables, (D(2001, 8, 20), "a", "x", 1, 5, "ADVANCE", None))
    salary = paid(tables, (D(2001, 8, 31), "a", "x", 1, 7, "PAYMENT", None))
    for run in (advance, salary, advance, salary):
        payroll.write_payroll_run(payroll.PayrollRun(run, run), root)
    stored = source.read_table(spark, root, name)
    assert rows(stored, "payment_type", "amount") == [("ADVANCE", 5), ("PAYMENT", 7)]
    assert stored.columns == PAID.split() + ["month"]


def test_a_date_range_reads_only_its_months(tables, spark, tmp_path):
    root, name = str(tmp_path), "outgoing_pay_document"
    months = [(D(2001, m, 5), "a", "x", 1, m, "ADVANCE", None) for m in range(1, 13)]
    source.reload_table(paid(tables, *months), root, name)
    stored = source.read_table(spark, root, name)
    ranged = source.in_date_range(stored, "payment_date", D(2001, 3, 2), D(2001, 5, 1))
    assert rows(ranged, "amount") == [(3,), (4,)]
    scan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in scan and "PushedFilters: [IsNotNull(payment_date)" in scan


def test_stored_tables_give_the_same_reports_as_the_views(spark, tmp_path):
    views = StarTables(spark, "/root/testdata/sf0.001")
    source.reload_tables(views, str(tmp_path))
    stored = source.read_tables(spark, str(tmp_path))
    for name, table in TABLES.items():
        assert stored[name].columns[: len(table.schema.fields)] == table.schema.names
    as_of = D(2001, 6, 30)
    for report in (reports.client_statistics, reports.debtors, lambda t: reports.payroll_year(t, as_of)):
        assert rows(report(stored)) == rows(report(views))


def test_insert_ignore(spark):
    existing = spark.createDataFrame([("a", "x")], "account_no string, bik string")
    candidates = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "x")], "account_no string, bik string")
    assert rows(source.insert_ignore(existing, candidates, ["account_no", "bik"])) == [("a", "x"), ("a", "y"), ("b", "x")]


def test_update_rows(spark):
    target = spark.createDataFrame([(1, "keep", 10), (2, "keep", 20), (3, "keep", 30)], "id long, note string, total long")
    updates = spark.createDataFrame([(2, 99), (3, None), (4, 1)], "id long, total long")
    updated = source.update_rows(target, updates, ["id"], ["total"])
    assert updated.columns == target.columns
    assert rows(updated) == [(1, "keep", 10), (2, "keep", 99), (3, "keep", 30)]


def test_a_stream_that_restarts_appends_each_file_once(spark, tmp_path):
    data, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def arrive(first):
        spark.range(first, first + 5).coalesce(1).write.mode("append").parquet(data)

    def run():
        stream = spark.readStream.schema("id long").parquet(data)
        append(stream, out, checkpoint, once=True).awaitTermination()

    arrive(0)
    run()
    run()
    arrive(5)
    run()
    stored = spark.read.parquet(out)
    assert stored.count() == 10 and stored.agg(F.countDistinct("id")).first()[0] == 10


def test_staged_steps_can_be_dropped(spark):
    folder = shared_folder(spark, "step")
    step = source.stage(spark.range(3), folder)
    assert step.count() == 3 and os.path.isdir(folder.removeprefix("file:"))
    assert drop_staged(spark) >= 1 and not os.path.exists(folder.removeprefix("file:"))
    assert drop_staged(spark) == 0


def test_sessions_join_partitions_up_to_a_size_that_tasks_can_hold(spark):
    # At Spark's 64 MB a task that joins and groups contract lines took 1.7 GB.
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
