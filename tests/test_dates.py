"""Calendar rules against plain loops over every date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from legalops.functions import dates


def _is_off(d: dt.date) -> bool:
    return d.weekday() >= 5 or (d.month == 1 and d.day <= 14)


def _stepped_back(d: dt.date) -> dt.date:
    while _is_off(d):
        d -= dt.timedelta(days=1)
    return d


def test_workday_matches_a_loop_for_every_date(spark):
    every = spark.range(1).select(
        F.explode(F.sequence(F.lit("1995-01-01").cast("date"), F.lit("2039-12-31").cast("date"))).alias("d")
    )
    got = every.select("d", dates.workday_on_or_before(F.col("d")).alias("w")).collect()
    assert len(got) > 16000
    assert [(r.d, r.w) for r in got if r.w != _stepped_back(r.d)] == []


def test_payment_dates(spark):
    months = spark.createDataFrame([(dt.date(2000, 12, 1),), (dt.date(2001, 3, 1),)], "m date")
    got = months.select(dates.advance_date(F.col("m")), dates.salary_date(F.col("m"))).collect()
    # 25 December 2000 is a Monday; 10 January is in the holidays and 31 December 2000 a Sunday.
    assert tuple(got[0]) == (dt.date(2000, 12, 25), dt.date(2000, 12, 29))
    # 25 March 2001 is a Sunday.
    assert tuple(got[1]) == (dt.date(2001, 3, 23), dt.date(2001, 4, 10))


def test_month_sequence_is_empty_when_it_ends_before_it_starts(spark):
    one = spark.range(1).select(
        F.size(dates.month_sequence(dates.day("2001-02-15"), dates.day("2001-04-01"))).alias("three"),
        F.size(dates.month_sequence(dates.day("2001-02-15"), dates.day("2001-01-31"))).alias("none"),
    )
    assert tuple(one.first()) == (3, 0)
