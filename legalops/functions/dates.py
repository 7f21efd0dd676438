"""Calendar expressions. All take and return date columns; none reads the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from legalops.model import ADVANCE_DAY, HOLIDAY_LAST_DAY_OF_JANUARY, SALARY_DAY


def day(value: dt.date | str | Column) -> Column:
    """A date literal; a column passes through."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def month_start(column: Column | str) -> Column:
    return F.trunc(column, "month")


def in_previous_year(column: Column, as_of: dt.date) -> Column:
    """In the calendar year before `as_of`. The bounds are literals, so they reach the scan."""
    first = as_of.year - 1
    return (column >= day(dt.date(first, 1, 1))) & (column < day(dt.date(first + 1, 1, 1)))


def month_name(column: Column | str) -> Column:
    """The month's English name in full."""
    return F.date_format(column, "MMMM")


def _before_weekend(column: Column) -> Column:
    # weekday() counts from Monday = 0.
    return F.date_sub(column, F.greatest(F.weekday(column) - 4, F.lit(0)))


def _before_new_year_holidays(column: Column) -> Column:
    is_holiday = (F.month(column) == 1) & (F.dayofmonth(column) <= HOLIDAY_LAST_DAY_OF_JANUARY)
    return F.when(is_holiday, F.date_sub(column, F.dayofmonth(column))).otherwise(column)


def workday_on_or_before(column: Column) -> Column:
    """The date itself if it is a workday, else the last workday before it.

    Weekends and 1-14 January are off. Stepping over a weekend may land in the
    January holidays and stepping over those may land on a weekend, but then the
    date is in late December and one more weekend step is enough.
    """
    return _before_weekend(_before_new_year_holidays(_before_weekend(column)))


def advance_date(month: Column) -> Column:
    return workday_on_or_before(F.date_add(month, ADVANCE_DAY - 1))


def salary_date(month: Column) -> Column:
    return workday_on_or_before(F.date_add(F.add_months(month, 1), SALARY_DAY - 1))


def month_sequence(start: Column, end: Column) -> Column:
    """First days of the months from `start`'s to `end`'s; empty if `end` is earlier."""
    first = F.trunc(start, "month")
    last = F.trunc(end, "month")
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.when(first <= last, months).otherwise(F.array().cast("array<date>"))
