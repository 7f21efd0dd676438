"""Price lists: their calendar, their prices, forks, and the check of contract lines."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.functions.dates import day
from legalops.functions.money import to_money_floor, to_money_nearest
from legalops.model import (
    ASSIGNMENT_KEY,
    CLIENT_TYPES,
    MARKUP,
    SURCHARGE_PER_QUARTER,
    VALUE_ADDED_TAX,
    YEARLY_INFLATION,
)
from legalops.session import spread
from legalops.sources.tables import Tables


def price_list_calendar(span: DataFrame, step_months: int = 3) -> DataFrame:
    """Price lists every `step_months` from `span`'s first to its last date.

    `span` has one row (start, end), the start being the first list's date.
    Inflation counts from the start's year.
    """
    dates = span.select(
        F.year("start").alias("start_year"),
        F.explode(F.sequence("start", "end", F.expr(f"interval {step_months} month"))).alias("creation_date"),
    )
    years = (F.year("creation_date") - F.col("start_year")).cast("double")
    return dates.select(
        "creation_date",
        F.lit(VALUE_ADDED_TAX).alias("nds"),
        (F.quarter("creation_date") * SURCHARGE_PER_QUARTER).alias("extra_charge"),
        F.round(F.pow(F.lit(YEARLY_INFLATION), years), 4).alias("inflation_rate"),
    )


def markup(client_type: Column) -> Column:
    factor = F.lit(None).cast("double")
    for kind in CLIENT_TYPES:
        factor = F.when(client_type == kind, F.lit(MARKUP[kind])).otherwise(factor)
    return factor


def list_price(base: Column, nds: Column, extra_charge: Column, inflation_rate: Column, client_type: Column) -> Column:
    """Inflation first, then tax, then the client type's markup, then the surcharge."""
    charged = base * inflation_rate * (F.lit(1.0) + nds) * markup(client_type)
    return to_money_floor(charged) + extra_charge


def build_price_list(service: DataFrame, price_list: DataFrame, *dealt_by: str, tasks: int | None = None) -> DataFrame:
    """A price for every service in every list for every client type.

    A list's key is its date, so there is at most one a day and all of them fit in
    one array; each service row carries it and unfolds it, without a join. Services are
    spread first: a file of them that one task reads unfolds into many times its rows. Where
    they are dealt by `dealt_by` into `tasks`, so are their prices, which need no shuffle to
    meet rows dealt alike.
    """
    lists = price_list.agg(
        F.collect_list(F.struct("creation_date", "nds", "extra_charge", "inflation_rate")).alias("lists")
    )
    priced = spread(service.select("id_service", "price"), *dealt_by, tasks=tasks).select(
        "id_service", "price", F.explode(lists.scalar()).alias("list")
    )
    priced = priced.select(
        "id_service",
        F.col("price").alias("base"),
        "list.*",
        F.explode(F.array(*[F.lit(kind) for kind in CLIENT_TYPES])).alias("client_type"),
    )
    price = list_price(
        F.col("base"), F.col("nds"), F.col("extra_charge"), F.col("inflation_rate"), F.col("client_type")
    )
    return priced.select("id_service", "creation_date", price.alias("price"), "client_type")


class Fork(NamedTuple):
    price_list: DataFrame
    price_list_service: DataFrame


def fork_price_list(t: Tables, source_date: dt.date, rate: float, new_date: dt.date) -> Fork:
    """The rows of a new list with the source list's services, `rate` percent cheaper.

    A negative rate raises prices. Fails if the source list is missing or the new
    date already has a list.
    """
    header = t["price_list"].where(F.col("creation_date") == day(source_date))
    if header.isEmpty():
        raise ValueError(f"no price list of {source_date}")
    if not t["price_list"].where(F.col("creation_date") == day(new_date)).isEmpty():
        raise ValueError(f"there is a price list of {new_date} already")
    rows = t["price_list_service"].where(F.col("creation_date") == day(source_date))
    return Fork(
        header.withColumn("creation_date", day(new_date)),
        rows.select(
            "id_service",
            day(new_date).alias("creation_date"),
            to_money_nearest(F.col("price") * F.lit(1 - rate / 100)).alias("price"),
            "client_type",
        ),
    )


def look_up_prices(lines: DataFrame, t: Tables) -> DataFrame:
    """Add `client_type` and `list_price`: what the agreement's list asks of such a client.

    Both are NULL where nothing is found. All joins are on whole keys, at most one
    match a line. The client type is put on the agreements first, so that lines, the
    longer side, are moved twice and not three times. No side is forced to broadcast:
    Spark does so where it knows one to be small, and splits the partitions of a
    frequent client or service otherwise. Prices are merged always: they may be unfolded
    from services and lists, which Spark takes to be no larger than the services alone.
    """
    agreements = (
        t["assignment_agreement"]
        .select(*ASSIGNMENT_KEY, "creation_price_list_date")
        .join(t["client"].select("id_client", "client_type"), "id_client")
    )
    prices = t["price_list_service"].select(
        "id_service",
        F.col("creation_date").alias("creation_price_list_date"),
        "client_type",
        F.col("price").alias("list_price"),
    )
    return lines.join(agreements, list(ASSIGNMENT_KEY), "left").join(
        prices.hint("merge"), ["id_service", "creation_price_list_date", "client_type"], "left"
    )


class PriceCheck(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame
    changes: DataFrame


def check_contract_prices(lines: DataFrame, t: Tables) -> PriceCheck:
    """Put contract lines at their list price.

    accepted: lines as given, at the list price. rejected: lines that no list
    prices, with the client type looked up. changes: old and new price of the
    accepted lines that had another price or none.
    """
    return sort_out(look_up_prices(lines, t), lines.columns)


def sort_out(looked_up: DataFrame, line_columns: list[str]) -> PriceCheck:
    """Split looked-up lines into accepted ones, rejected ones and changes."""
    found = looked_up.where(F.col("list_price").isNotNull())
    columns = [c for c in line_columns if c != "price"]
    return PriceCheck(
        found.select(*columns, F.col("list_price").alias("price")),
        looked_up.where(F.col("list_price").isNull()).select(*line_columns, "client_type"),
        found.where(~F.col("price").eqNullSafe(F.col("list_price"))).select(
            *columns, F.col("price").alias("old_price"), F.col("list_price").alias("new_price")
        ),
    )


class PricedLines(NamedTuple):
    priced: DataFrame
    unpriced: DataFrame


def price_contract_lines(lines: DataFrame, t: Tables) -> PricedLines:
    """Lines without a price, priced from their agreement's list.

    unpriced: the lines that no list prices, with the client type looked up.
    """
    looked_up = look_up_prices(lines, t)
    found = F.col("list_price").isNotNull()
    columns = [c for c in lines.columns if c != "price"]
    return PricedLines(
        looked_up.where(found).select(*columns, F.col("list_price").alias("price")),
        looked_up.where(~found).select(*columns, "client_type"),
    )
