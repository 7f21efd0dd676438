"""The five reports and their variants.

Each side of a report is brought down to one row per client, employee or service
before it is joined, so no join multiplies rows and no key's rows meet in one task
unaggregated. Keys and references are taken to hold (see `operators.quality`), so
tables that would only confirm a reference are not joined.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legalops.functions.dates import day, in_previous_year, month_name, month_start
from legalops.model import ASSIGNMENT_KEY, CLIENT_TYPES
from legalops.operators.names import client_names, client_payments
from legalops.sources.tables import MONTH, Tables, in_date_range

MONTHS = [calendar.month_name[m].lower() for m in range(1, 13)]


def _or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).alias(column)


# --- Clients -----------------------------------------------------------------


def _agreements_of_clients(t: Tables) -> DataFrame:
    """Per client: agreements, cooperations that have any, and the last dates."""
    by_cooperation = (
        t["assignment_agreement"]
        .groupBy("id_client", "cooperation_agreement_no")
        .agg(
            F.count("*").alias("agreements"),
            F.max("created_at").alias("created_at"),
            F.max("completion_date").alias("completion_date"),
        )
    )
    return by_cooperation.groupBy("id_client").agg(
        F.sum("agreements").alias("agreements"),
        F.count("*").alias("used_cooperations"),
        F.max("created_at").alias("last_agreement_date"),
        F.max("completion_date").alias("last_completion_date"),
    )


def _services_of_clients(t: Tables) -> DataFrame:
    """Per client: contract lines and the service with most of them, ties by name.

    Lines whose service is not in the catalogue count as lines, but have no name to be
    the top one by.
    """
    names = t["service"].select("id_service", "name_service")
    uses = t["contract_service"].groupBy("id_client", "id_service").agg(F.count("*").alias("uses")).join(names, "id_service", "left")
    # The smallest (-uses, name) is the top one; as an aggregate it is reduced
    # before the shuffle, which ranking all services of a client would not be.
    named = F.when(F.col("name_service").isNotNull(), F.struct((-F.col("uses")).alias("rank"), "name_service"))
    return uses.groupBy("id_client").agg(
        F.sum("uses").alias("services"), F.min(named)["name_service"].alias("top_service")
    )


def _accounts_of_clients(t: Tables) -> DataFrame:
    """Per client: the accounts it paid from, sorted, separated by commas."""
    accounts = client_payments(t).select("id_client", "account_no").distinct()
    return accounts.groupBy("id_client").agg(
        F.expr("listagg(CAST(account_no AS STRING), ',') WITHIN GROUP (ORDER BY account_no)").alias("accounts")
    )


def client_statistics(t: Tables) -> DataFrame:
    """One row per client: agreements, services used, dates, top service, accounts.

    The average counts a cooperation without assignments as one agreement without
    services.
    """
    cooperations = t["cooperation_agreement"].groupBy("id_client").agg(F.count("*").alias("cooperations"))
    joined = (
        client_names(t)
        .join(cooperations, "id_client", "left")
        .join(_agreements_of_clients(t), "id_client", "left")
        .join(_services_of_clients(t), "id_client", "left")
        .join(_accounts_of_clients(t), "id_client", "left")
    )
    bare = F.col("cooperations") - F.coalesce(F.col("used_cooperations"), F.lit(0))
    counted = F.coalesce(F.col("agreements"), F.lit(0)) + bare
    average = F.coalesce(F.col("services"), F.lit(0)) / F.nullif(counted, F.lit(0))
    return joined.select(
        "name",
        "id_client",
        "created_at",
        _or_zero("agreements"),
        _or_zero("services"),
        F.round(F.coalesce(average, F.lit(0.0)), 0).alias("avg_services_per_agreement"),
        "last_agreement_date",
        "last_completion_date",
        "top_service",
        "accounts",
    ).orderBy(F.asc_nulls_last("name"), "id_client")


def charges(t: Tables) -> DataFrame:
    """Per client: the sum of its contract lines."""
    return t["contract_service"].groupBy("id_client").agg(F.sum("price").alias("charged"))


def payments(t: Tables) -> DataFrame:
    """Per client: the sum paid, the last payment's date and its account.

    Of payments on one day the one with the highest id is the last.
    """
    latest = F.max_by("account_no", F.struct("payment_date", "id_income_pay_document"))
    return (
        client_payments(t)
        .groupBy("id_client")
        .agg(
            F.sum("amount").alias("paid"),
            F.max("payment_date").alias("last_payment_date"),
            latest.alias("last_payment_account"),
        )
    )


def debtors(t: Tables) -> DataFrame:
    """Clients charged more than they paid; those who never paid have paid 0."""
    agreements = t["assignment_agreement"].groupBy("id_client").agg(
        F.count("*").alias("agreements"), F.max("created_at").alias("last_agreement_date")
    )
    owing = (
        charges(t)
        .join(payments(t), "id_client", "left")
        .withColumn("paid", F.coalesce("paid", F.lit(0)))
        .withColumn("debt", F.col("charged") - F.col("paid"))
        .where(F.col("debt") > 0)
    )
    return (
        owing.join(agreements, "id_client", "left")
        .join(client_names(t), "id_client")
        .select(
            "name",
            "id_client",
            _or_zero("agreements"),
            "charged",
            "paid",
            "last_agreement_date",
            "last_payment_date",
            "last_payment_account",
            "debt",
        )
    )


# --- Managers ----------------------------------------------------------------


def manager_months(t: Tables, as_of: dt.date) -> DataFrame:
    """Per manager and month of last year with agreements: their number and its change.

    The change is in percent against the manager's previous month that has any, in
    whole hundreds (the division drops the fraction), 0 for a first month. Agreements
    without a manager form rows of their own.
    """
    counts = (
        t["cooperation_agreement"]
        .where(in_previous_year(F.col("start_date"), as_of))
        .groupBy("manager_number", month_start("start_date").alias("month_start"))
        .agg(F.count("cooperation_agreement_no").alias("amount"))
    )
    # At most 12 rows a manager are left to order.
    previous = F.lag("amount").over(Window.partitionBy("manager_number").orderBy("month_start"))
    return counts.withColumn("previous", previous).select(
        "manager_number",
        F.month("month_start").alias("month"),
        month_name("month_start").alias("month_name"),
        "amount",
        F.expr("coalesce(((amount - previous) div nullif(previous, 0)) * 100, 0)").alias("relative"),
    )


def manager_monthly(t: Tables, as_of: dt.date) -> DataFrame:
    """`manager_months` with one row per manager: 12 monthly counts and their change, 0 where there is none."""
    change = manager_months(t, as_of)
    wide = (
        change.groupBy("manager_number")
        .pivot("month", list(range(1, 13)))
        .agg(F.sum("amount").alias("amount"), F.sum("relative").alias("relative"))
    )
    columns = [
        F.coalesce(F.col(f"{number}_{kind}"), F.lit(0)).alias(f"{name}_{kind}")
        for number, name in enumerate(MONTHS, start=1)
        for kind in ("amount", "relative")
    ]
    return wide.select("manager_number", *columns).orderBy(F.asc_nulls_last("manager_number"))


def manager_monthly_calendar(t: Tables, as_of: dt.date) -> DataFrame:
    """Per employee: 12 monthly counts of last year and the true change in percent.

    January compares with the December before. NULL where the month before had none.
    """
    year = as_of.year - 1
    spine = [dt.date(year - 1, 12, 1)] + [dt.date(year, month, 1) for month in range(1, 13)]
    start = F.col("start_date")
    counts = (
        t["cooperation_agreement"]
        .where((start >= day(spine[0])) & (start < day(dt.date(year + 1, 1, 1))))
        .where(F.col("manager_number").isNotNull())
        .groupBy(F.col("manager_number").alias("employee_number"))
        .agg(
            *[
                F.count(F.when(month_start(start) == day(month), 1)).alias(f"_{i}")
                for i, month in enumerate(spine)
            ]
        )
    )
    joined = t["employee"].select("employee_number", "fio").join(counts, "employee_number", "left")
    columns = []
    for i, name in enumerate(MONTHS, start=1):
        now, before = (F.coalesce(F.col(f"_{j}"), F.lit(0)) for j in (i, i - 1))
        columns.append(now.alias(f"{name}_amount"))
        columns.append(((now - before) * 100.0 / F.nullif(before, F.lit(0))).alias(f"{name}_relative"))
    return joined.select("employee_number", "fio", *columns).orderBy("employee_number")


# --- Services ----------------------------------------------------------------


def _usage(t: Tables) -> DataFrame:
    """Per used service: agreements that use it and how often each does on average."""
    per_agreement = (
        t["contract_service"].groupBy("id_service", *ASSIGNMENT_KEY).agg(F.count("*").alias("uses"))
    )
    return per_agreement.groupBy("id_service").agg(
        F.count("*").alias("agreements"), F.round(F.avg("uses"), 0).alias("avg_uses")
    )


def _with_usage(t: Tables, prices: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    names = t["service"].select("id_service", "name_service")
    return (
        names.join(_usage(t), "id_service")
        .join(prices, "id_service")
        .select("name_service", "agreements", "avg_uses", *columns)
        .orderBy(F.desc("agreements"), "name_service", *order)
    )


def service_popularity(t: Tables) -> DataFrame:
    """Per used service and client type: usage, and the highest and lowest list price."""
    prices = (
        t["price_list_service"]
        .groupBy("id_service", "client_type")
        .agg(F.max("price").alias("max_price"), F.min("price").alias("min_price"))
    )
    return _with_usage(t, prices, ["client_type", "max_price", "min_price"], ["client_type"])


def service_popularity_wide(t: Tables) -> DataFrame:
    """The same with one row per service and two price columns per client type."""
    prices = (
        t["price_list_service"]
        .groupBy("id_service")
        .pivot("client_type", list(CLIENT_TYPES))
        .agg(F.max("price").alias("max"), F.min("price").alias("min"))
    )
    columns = [(f"{kind}_{bound}", f"{bound}_{kind.lower()}") for kind in CLIENT_TYPES for bound in ("max", "min")]
    renamed = prices.select("id_service", *[F.col(old).alias(new) for old, new in columns])
    return _with_usage(t, renamed, [new for _, new in columns], [])


def service_popularity_current(t: Tables, as_of: dt.date) -> DataFrame:
    """The same with the prices of the list in force at `as_of`."""
    # One value, so that the scan of a stored table reads that list's folder only.
    in_force = t["price_list"].where(F.col("creation_date") <= day(as_of)).agg(F.max("creation_date")).scalar()
    prices = t["price_list_service"].where(F.col("creation_date") == in_force)
    if MONTH in prices.columns:
        prices = prices.where(F.col(MONTH) == month_start(in_force))
    prices = prices.select("id_service", "client_type", F.col("price").alias("current_price"))
    return _with_usage(t, prices, ["client_type", "current_price"], ["client_type"])


# --- Payroll -----------------------------------------------------------------


def payroll_year(t: Tables, as_of: dt.date, null_is_owed: bool = False) -> DataFrame:
    """Per employee with payroll rows this year, before `as_of`: counts, paid and owed.

    A row whose result is NULL counts as neither paid nor owed, or as owed with
    `null_is_owed`.
    """
    rows = in_date_range(t["outgoing_pay_document"], "payment_date", dt.date(as_of.year, 1, 1), as_of)
    paid = F.col("result") == F.lit(True)
    owed = ~F.col("result").eqNullSafe(F.lit(True)) if null_is_owed else F.col("result") == F.lit(False)
    kind = F.col("payment_type")
    totals = rows.groupBy("employee_number").agg(
        F.sum(F.when(kind == "ADVANCE", 1).otherwise(0)).alias("advances"),
        F.sum(F.when(kind == "PAYMENT", 1).otherwise(0)).alias("salaries"),
        F.sum(F.when(paid, F.col("amount")).otherwise(0)).alias("paid"),
        F.sum(F.when(owed, F.col("amount")).otherwise(0)).alias("owed"),
        F.min(F.when(owed, F.col("payment_date"))).alias("oldest_unpaid_date"),
    )
    return (
        totals.join(t["employee"].select("employee_number", "fio"), "employee_number")
        .select("employee_number", "fio", "advances", "salaries", "paid", "owed", "oldest_unpaid_date")
    )
