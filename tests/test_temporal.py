"""As-of and overlap joins against plain loops."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from legalops.operators import temporal
from legalops.operators.temporal import as_of_join, overlap_join

DAY = dt.date(2000, 1, 1)


def _day(rng, n):
    return None if rng.random() < 0.08 else DAY + dt.timedelta(days=rng.randrange(n))


def _key(rng):
    # A third of the rows share a key.
    return None if rng.random() < 0.05 else 0 if rng.random() < 0.35 else rng.randrange(1, 5)


@pytest.mark.parametrize("blocks", [None, 7])
def test_as_of_join_equals_a_loop(spark, blocks):
    rng = random.Random(1)
    left = [(i, _key(rng), "x", _day(rng, 60)) for i in range(400)]
    left += left[:3]
    right = [(_key(rng), rng.choice("xy"), _day(rng, 60), rng.randrange(9), rng.choice([None, "a", "b"])) for _ in range(120)]
    made = as_of_join(
        spark.createDataFrame(left, "id int, k int, l string, d date"),
        spark.createDataFrame(right, "k int, l string, since date, price int, note string"),
        ["k", "l"], "d", "since", ["price", "note"], blocks,
    )
    assert made.columns == ["id", "k", "l", "d", "price", "note"]
    want = []
    for row in left:
        _, k, l, d = row
        fits = [r for r in right if None not in (k, d, r[0], r[2]) and r[0] == k and r[1] == l and r[2] <= d]
        last = max(fits, key=lambda r: (r[2], r[3], r[4] is not None, r[4] or ""), default=(None,) * 5)
        want.append((*row, last[3], last[4]))
    assert sorted(map(repr, (tuple(r) for r in made.collect()))) == sorted(map(repr, want))


def test_as_of_join_without_keys_or_rows(spark):
    left = spark.createDataFrame([(1, DAY), (2, None), (3, DAY + dt.timedelta(9))], "id int, d date")
    right = spark.createDataFrame([(DAY + dt.timedelta(5), 7)], "since date, price int")
    assert sorted(map(tuple, as_of_join(left, right, [], "d", "since", ["price"]).select("id", "price").collect())) == [(1, None), (2, None), (3, 7)]
    assert {r["price"] for r in as_of_join(left, right.where("false"), [], "d", "since", ["price"]).collect()} == {None}
    assert as_of_join(left.where("false"), right, [], "d", "since", ["price"]).collect() == []
    with pytest.raises(ValueError):
        as_of_join(left, right.withColumnRenamed("price", "id"), [], "d", "since", ["id"])


def _periods(rng, n):
    made = []
    for i in range(n):
        start, long = _day(rng, 90), rng.random() < 0.1
        end = None if rng.random() < 0.1 or start is None else start + dt.timedelta(days=rng.randrange(-2, 80 if long else 9))
        made.append((i, _key(rng), start, end))
    return made


@pytest.mark.parametrize("blocks", [None, 5])
def test_overlap_join_equals_a_loop(spark, blocks, monkeypatch):
    monkeypatch.setattr(temporal, "STARTS", 8)
    rng = random.Random(2)
    left, right = _periods(rng, 250), _periods(rng, 180)
    left.append(left[1])
    schema = "id int, k int, s date, e date"
    made = overlap_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"], ("s", "e"), ("s", "e"), blocks)

    def usable(r):
        return r[1] is not None and r[2] is not None and (r[3] is None or r[3] > r[2])

    want = [
        (a[0], b[0])
        for a in left
        for b in right
        if usable(a) and usable(b) and a[1] == b[1] and (b[3] is None or a[2] < b[3]) and (a[3] is None or b[2] < a[3])
    ]
    assert sorted(map(tuple, made.select("left.id", F.col("right.id").alias("other")).collect())) == sorted(want)
    assert len(want) > 1000


def test_overlap_join_of_empty_sides(spark):
    rows = spark.createDataFrame([(1, 1, DAY, None)], "id int, k int, s date, e date")
    assert overlap_join(rows, rows.where("false"), ["k"], ("s", "e"), ("s", "e")).collect() == []
    assert overlap_join(rows.where("false"), rows, ["k"], ("s", "e"), ("s", "e")).collect() == []
    assert overlap_join(rows, rows, ["k"], ("s", "e"), ("s", "e")).count() == 1


def test_no_pairs_are_formed_in_vain(spark, monkeypatch):
    """Short periods of one hot key: the join on blocks gives few rows beside the result."""
    monkeypatch.setattr(temporal, "STARTS", 16)
    n = 4000
    rows = spark.range(n).select(F.col("id"), F.lit(1).alias("k"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("s"), F.date_add(F.lit(DAY), (F.col("id") + 2).cast("int")).alias("e"))
    met = []
    real = temporal._met

    def counted(*args):
        met.append(real(*args))
        return met[-1]

    monkeypatch.setattr(temporal, "_met", counted)
    assert overlap_join(rows, rows, ["k"], ("s", "e"), ("s", "e")).count() == n + 2 * (n - 1)
    # All pairs would be 16 million.
    assert sum(m.count() for m in met) <= 2 * n * 2 * 16


def _prices(rng, keys):
    return [(k, DAY + dt.timedelta(days=rng.randrange(60)), rng.randrange(9)) for k in keys]


def _last_price(row, prices):
    return max(((since, price) for k, since, price in prices if k == row[1] and since <= row[2]), default=(None, None))[1]


def test_as_of_join_writes_no_right_rows_and_moves_no_dealt_side(spark, monkeypatch):
    rng = random.Random(3)
    left = [(i, rng.randrange(3000), DAY + dt.timedelta(days=rng.randrange(60))) for i in range(2000)]
    prices = _prices(rng, [k % 3000 for k in range(9000)])
    written = []
    real = temporal.stage

    def staged(df, *args, **options):
        written.append(real(df, *args, **options))
        return written[-1]

    monkeypatch.setattr(temporal, "stage", staged)
    monkeypatch.setattr(temporal, "running", lambda *args: pytest.fail("no key is large"))
    right = spark.createDataFrame(prices, "k long, since date, price int").repartition(4, "k")
    made = as_of_join(spark.createDataFrame(left, "id int, k long, d date"), right, ["k"], "d", "since", ["price"], 4, ["k"])
    assert sorted(map(tuple, made.collect())) == sorted((*r, _last_price(r, prices)) for r in left)
    assert [w.count() for w in written] == [len(left)]
    # The left side is moved once, and the right side as it was dealt.
    plan = made._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 2


def test_as_of_join_cuts_only_large_keys_into_blocks(spark, monkeypatch):
    rng = random.Random(4)
    left = [(i, 5 if i % 2 else rng.randrange(500), DAY + dt.timedelta(days=rng.randrange(60))) for i in range(2000)]
    # One key has many rows on the left, another on the right.
    prices = _prices(rng, [k % 500 for k in range(1000)] + [7] * 600)
    met = []
    real = temporal.running

    def counted(df, *args):
        met.append(df.groupBy("_key0", "_side").count().collect())
        return real(df, *args)

    monkeypatch.setattr(temporal, "running", counted)
    made = as_of_join(
        spark.createDataFrame(left, "id int, k int, d date"), spark.createDataFrame(prices, "k long, since date, price int"),
        ["k"], "d", "since", ["price"], 6,
    )
    assert made.schema["k"].dataType.simpleString() == "int"
    assert sorted(map(tuple, made.collect())) == sorted((*r, _last_price(r, prices)) for r in left)
    (rows,) = met
    assert sum(r["count"] for r in rows if r["_key0"] == 5 and r["_side"]) > 990
    assert sum(r["count"] for r in rows if r["_key0"] == 7 and not r["_side"]) > 600
    assert len({r["_key0"] for r in rows}) < 50
