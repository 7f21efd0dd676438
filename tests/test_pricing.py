"""Price lists, forks and the check of contract lines."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from legalops.operators import pricing
from legalops.sources.star import ArrivingLines
from legalops.streaming.prices import check_arriving_lines
from legalops.streaming.sink import append
from tests.conftest import rows

D = dt.date
LINE = "id long, id_service long, assignment_agreement_no long, cooperation_agreement_no long, id_client long, price long"


def test_calendar(spark):
    span = spark.createDataFrame([(D(1999, 10, 1), D(2000, 4, 1))], "start date, end date")
    assert rows(pricing.price_list_calendar(span)) == [
        (D(1999, 10, 1), 0.2, 20, 1.0),
        (D(2000, 1, 1), 0.2, 5, 1.02),
        (D(2000, 4, 1), 0.2, 10, 1.02),
    ]


def test_build_price_list(tables):
    t = tables(
        service=("id_service name_service price", [(1, "a", 1000), (2, "b", 7)]),
        price_list=("creation_date nds extra_charge inflation_rate", [(D(2000, 1, 1), 0.2, 5, 1.02), (D(2000, 4, 1), 0.2, 10, 1.0)]),
    )
    prices = {(s, d.month, c): p for s, d, p, c in rows(pricing.build_price_list(t["service"], t["price_list"]))}
    assert len(prices) == 12
    # 1000 * 1.02 * 1.2 = 1224, then the type's markup, cut to a whole, then the surcharge.
    assert [prices[1, 1, c] for c in ("PERSON", "ENTREPRENEUR", "LEGAL")] == [1229, 1351, 1596]
    assert prices[2, 4, "LEGAL"] == 10 + 10


def test_services_of_one_file_unfold_in_many_tasks(spark, tables):
    t = tables(price_list=("creation_date nds extra_charge inflation_rate", [(D(2000, 1, 1), 0.2, 5, 1.0)]))
    service = spark.range(100).coalesce(1).select(F.col("id").alias("id_service"), F.col("id").alias("price"))
    prices = pricing.build_price_list(service, t["price_list"])
    by_task = prices.groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) == 4 and sum(r["count"] for r in by_task) == 300
    assert max(r["count"] for r in by_task) < 150


def priced(tables, **more):
    return tables(
        **{
            "price_list": ("creation_date nds extra_charge inflation_rate", [(D(2000, 1, 1), 0.2, 5, 1.0)]),
            "price_list_service": (
                "id_service creation_date price client_type",
                [(1, D(2000, 1, 1), 25, "LEGAL"), (1, D(2000, 1, 1), 45, "PERSON"), (2, D(2000, 1, 1), 9, "LEGAL")],
            ),
            "client": ("id_client client_type", [(1, "LEGAL"), (2, "PERSON")]),
            "assignment_agreement": (
                "assignment_agreement_no cooperation_agreement_no id_client creation_price_list_date",
                [(1, 10, 1, D(2000, 1, 1)), (1, 20, 2, D(2000, 1, 1)), (2, 10, 1, None)],
            ),
            **more,
        }
    )


def test_fork(tables):
    t = priced(tables)
    forked = pricing.fork_price_list(t, D(2000, 1, 1), 10, D(2000, 1, 2))
    assert rows(forked.price_list) == [(D(2000, 1, 2), 0.2, 5, 1.0)]
    # 22.5 and 40.5 round to the even neighbour, 8.1 to the nearest.
    assert rows(forked.price_list_service, "id_service", "client_type", "price") == [
        (1, "LEGAL", 22), (1, "PERSON", 40), (2, "LEGAL", 8),
    ]
    raised = pricing.fork_price_list(t, D(2000, 1, 1), -100, D(2000, 1, 2))
    assert sorted(r.price for r in raised.price_list_service.collect()) == [18, 50, 90]


def test_fork_refuses_missing_source_and_taken_date(tables):
    t = priced(tables)
    with pytest.raises(ValueError, match="no price list"):
        pricing.fork_price_list(t, D(1999, 1, 1), 10, D(2000, 1, 2))
    with pytest.raises(ValueError, match="already"):
        pricing.fork_price_list(t, D(2000, 1, 1), 10, D(2000, 1, 1))


LINES = [
    (1, 1, 1, 10, 1, 25),  # right
    (2, 1, 1, 10, 1, 10000),  # wrong
    (3, 1, 1, 20, 2, None),  # without a price
    (4, 2, 1, 20, 2, 9),  # no such price for a person
    (5, 1, 2, 10, 1, 25),  # agreement without a list
    (6, 1, 9, 90, 1, 25),  # no such agreement
]


def test_check_contract_prices(spark, tables):
    checked = pricing.check_contract_prices(spark.createDataFrame(LINES, LINE), priced(tables))
    assert rows(checked.accepted, "id", "price") == [(1, 25), (2, 25), (3, 45)]
    assert rows(checked.rejected, "id", "price", "client_type") == [
        (4, 9, "PERSON"), (5, 25, "LEGAL"), (6, 25, None),
    ]
    assert rows(checked.changes, "id", "old_price", "new_price") == [(2, 10000, 25), (3, None, 45)]


def test_prices_unfolded_from_services_are_not_broadcast(spark, tables):
    # Spark takes them for no larger than the services, however many lists there are.
    t = priced(tables, price_list=("creation_date nds extra_charge inflation_rate", [(D(2000, 1, 1), 0.2, 5, 1.0)]))
    service = spark.range(1, 3).select(F.col("id").alias("id_service"), (F.col("id") * 100).alias("price"))
    t["price_list_service"] = pricing.build_price_list(service, t["price_list"])
    checked = pricing.check_contract_prices(spark.createDataFrame(LINES, LINE), t)
    for frame in checked:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [id_service" in plan and "BroadcastHashJoin [id_service" not in plan
    assert rows(checked.accepted, "id", "price") == [(1, 161), (2, 161), (3, 125), (4, 245)]
    assert rows(checked.rejected, "id") == [(5,), (6,)]


def test_price_contract_lines(spark, tables):
    lines = spark.createDataFrame(LINES, LINE).drop("price")
    done = pricing.price_contract_lines(lines, priced(tables))
    assert rows(done.priced, "id", "price") == [(1, 25), (2, 25), (3, 45)]
    # No line is lost: what no list prices comes back too.
    assert done.priced.count() + done.unpriced.count() == lines.count()


def test_arriving_lines_are_checked_like_a_batch(spark, tables, tmp_path):
    t = priced(tables)
    source = str(tmp_path / "lines")
    for part in (LINES[:3], LINES[3:]):
        spark.createDataFrame(part, LINE).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(LINE).option("maxFilesPerTrigger", 1).parquet(source)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    check_arriving_lines(stream, t, out, checkpoint, once=True).awaitTermination()
    expected = pricing.check_contract_prices(spark.createDataFrame(LINES, LINE), t)
    for name, frame in zip(expected._fields, expected):
        assert rows(spark.read.parquet(f"{out}/{name}"), *frame.columns) == rows(frame), name
    assert {f.name for f in (tmp_path / "out" / "accepted").iterdir()} == {"batch_id=0", "batch_id=1"}


@pytest.mark.parametrize("folder", [True, False])
def test_order_lines_arrive_from_a_file_or_a_folder_of_files(spark, tmp_path, folder):
    given = pd.DataFrame({"l_orderkey": [1, 1, 2], "l_partkey": [7, 8, 9], "l_linenumber": [1, 2, 1], "l_returnflag": ["R", "A", "N"]})
    given = given.astype({"l_linenumber": "int32"})
    at = tmp_path / "lineitem.parquet"
    if folder:
        at.mkdir()
    for n, part in enumerate((given[:2], given[2:]) if folder else (given,)):
        part.to_parquet(at / f"part-{n}.parquet" if folder else at, index=False)
    given[:1].to_parquet(tmp_path / "orders.parquet", index=False)  # another table beside it
    out = str(tmp_path / "out")
    append(ArrivingLines(spark, str(tmp_path)).source("lineitem"), out, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert rows(spark.read.parquet(out).drop("batch_id")) == [tuple(r) for r in given.values.tolist()]
