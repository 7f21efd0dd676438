"""Payroll: one run for all staff, and the whole schedule since hiring."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.functions.dates import advance_date, day, month_sequence, salary_date
from legalops.model import ADVANCE_AMOUNT, PAYMENT_TYPES, TABLES
from legalops.sources.tables import Tables, in_date_range, read_table, replace_months


class PayrollRun(NamedTuple):
    rows: DataFrame
    total: DataFrame


def _month_after(first: dt.date) -> dt.date:
    return (first + dt.timedelta(days=31)).replace(day=1)


def _pay_date(kind: str, as_of: dt.date, payment_month: dt.date | None) -> dt.date:
    if kind not in PAYMENT_TYPES:
        raise ValueError(f"unknown payment type {kind!r}")
    return as_of if kind == "ADVANCE" else (payment_month or as_of.replace(day=1)) - dt.timedelta(days=1)


def payroll_run(t: Tables, kind: str, as_of: dt.date, payment_month: dt.date | None = None) -> PayrollRun:
    """New payment rows for everyone still employed, and their total.

    An ADVANCE is dated `as_of`. A PAYMENT is dated the day before `payment_month`,
    by default the first of `as_of`'s month. Fails if that month already has rows of
    the kind, or if a row's key (date, account, bank) is taken or would be repeated.
    """
    pay_date = _pay_date(kind, as_of, payment_month)
    if kind == "ADVANCE":
        amount = F.lit(ADVANCE_AMOUNT).cast("long")
    else:
        amount = F.greatest(F.col("salary") - ADVANCE_AMOUNT, F.lit(0)).cast("long")

    first = pay_date.replace(day=1)
    this_month = in_date_range(t["outgoing_pay_document"], "payment_date", first, _month_after(first))
    if not this_month.where(F.col("payment_type") == kind).isEmpty():
        raise ValueError(f"{kind} rows of {first:%Y-%m} exist already")

    staff = t["employee"].where(F.col("fire_date").isNull())
    key = ["account_no", "bik"]
    taken = this_month.where(F.col("payment_date") == day(pay_date)).select(*key)
    if not staff.join(taken, key, "left_semi").isEmpty():
        raise ValueError(f"an account is already paid on {pay_date}")
    if not staff.groupBy(*key).count().where(F.col("count") > 1).isEmpty():
        raise ValueError("two employees share an account, which can be paid once a day")

    rows = staff.select(
        day(pay_date).alias("payment_date"),
        "account_no",
        "bik",
        "employee_number",
        amount.alias("amount"),
        F.lit(kind).alias("payment_type"),
        F.lit(None).cast("boolean").alias("result"),
    )
    total = rows.agg(
        F.lit(kind).alias("payment_type"),
        F.count("*").alias("payments"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total_amount"),
    )
    return PayrollRun(rows, total)


def write_payroll_run(run: PayrollRun, root: str) -> None:
    """Store a run's rows; written again, the same run replaces itself and nothing else.

    A month's rows of a kind lie in a folder of their own, and a run fills one such.
    """
    replace_months(run.rows, root, "outgoing_pay_document")


def post_payroll_run(
    employee: DataFrame, root: str, kind: str, as_of: dt.date, payment_month: dt.date | None = None
) -> DataFrame:
    """Check against the stored payments and store the new ones, in one step; gives the run's total.

    The month and kind are claimed first, by a file that only one run can create, and the
    guards of `payroll_run` look at what is stored after that. So of two runs at once one
    fails, whatever the order of their reads and writes. A run that fails gives its claim
    back; one that dies leaves it, and the file has to be deleted before the next try.
    """
    spark, name = employee.sparkSession, "outgoing_pay_document"
    month = _pay_date(kind, as_of, payment_month).replace(day=1)
    path = spark._jvm.org.apache.hadoop.fs.Path
    claim = path(f"{root}/_payroll/{month}-{kind}")
    files = claim.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        files.create(claim, False).close()
    except Py4JJavaError as taken:
        raise ValueError(f"{kind} rows of {month:%Y-%m} are claimed by another run") from taken
    try:
        if files.exists(path(f"{root}/{name}")):
            spark.catalog.refreshByPath(f"{root}/{name}")
            stored = read_table(spark, root, name)
        else:
            stored = spark.createDataFrame([], TABLES[name].schema)
        run = payroll_run({"employee": employee, name: stored}, kind, as_of, payment_month)
        write_payroll_run(run, root)
    except BaseException:
        files.delete(claim, False)
        raise
    return run.total


def payroll_schedule(employee: DataFrame, as_of: dt.date, result: Column | None = None) -> DataFrame:
    """Advance and salary rows for each month an employee has worked up to `as_of`.

    The months run from the hire month to `as_of` or the dismissal, whichever is
    earlier. `result` says whether a row was paid; it may use the columns of
    `employee` and `month`, and is NULL if not given.
    """
    if result is None:
        result = F.lit(None).cast("boolean")
    last = F.least(F.coalesce(F.col("fire_date"), day(as_of)), day(as_of))
    with_account = employee.where(F.col("account_no").isNotNull() & F.col("bik").isNotNull())
    months = with_account.withColumn("month", F.explode(month_sequence(F.col("hire_date"), last)))

    advance = F.struct(
        advance_date(F.col("month")).alias("payment_date"),
        F.least(F.col("salary"), F.lit(ADVANCE_AMOUNT)).cast("long").alias("amount"),
        F.lit("ADVANCE").alias("payment_type"),
    )
    rest = F.struct(
        salary_date(F.col("month")).alias("payment_date"),
        F.greatest(F.col("salary") - ADVANCE_AMOUNT, F.lit(0)).cast("long").alias("amount"),
        F.lit("PAYMENT").alias("payment_type"),
    )
    # A salary the advance already covers leaves no second row.
    parts = F.when(F.col("salary") > ADVANCE_AMOUNT, F.array(advance, rest)).otherwise(F.array(advance))
    rows = months.withColumn("_part", F.explode(parts)).withColumn("_result", result)
    return rows.select(
        "_part.payment_date",
        "account_no",
        "bik",
        "employee_number",
        "_part.amount",
        "_part.payment_type",
        F.col("_result").alias("result"),
    )
