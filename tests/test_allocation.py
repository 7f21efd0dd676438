"""Allocation against a plain loop, batch and streaming, ordinary and large groups."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from legalops.functions.scans import BLOCK, Running, in_blocks, running
from legalops.operators import arrivals
from legalops.operators.allocation import allocate_payments
from legalops.streaming import allocation as streaming
from tests.conftest import rows

DOCUMENTS = (
    "id_payment_document long, id_payment_bundle long, assignment_agreement_no long,"
    "cooperation_agreement_no long, id_client long, amount long"
)
BUNDLES = "id_payment_bundle long, parent_cooperation_agreement_no long, id_client long, total_amount long"


def settle(events):
    """Pay documents one event at a time. Events: (kind, agreement, id, amount) in order."""
    open_documents, allocated, leftovers = {}, [], []
    for kind, agreement, number, amount in events:
        queue = open_documents.setdefault(agreement, {})
        if kind == "DOCUMENT":
            queue[number] = amount
            continue
        left = amount
        for document in sorted(queue):
            part = min(left, queue[document])
            if part > 0:
                allocated.append((*agreement, document, number, part))
                queue[document] -= part
                left -= part
        if left > 0:
            leftovers.append((*agreement, number, left))
    return allocated, open_documents, leftovers


def random_events(seed, agreements, documents_first):
    rng = random.Random(seed)
    events = []
    for client in range(agreements):
        agreement = (client % 3, client)
        mine = [("DOCUMENT", agreement, i, rng.choice([0, 0, 1, 5, rng.randint(1, 10**9)])) for i in range(rng.randint(0, 9))]
        paid = [("PAYMENT", agreement, i, rng.choice([0, 1, 5, rng.randint(1, 2 * 10**9)])) for i in range(rng.randint(0, 6))]
        if documents_first:
            events += mine + paid
        else:
            order = ["D"] * len(mine) + ["P"] * len(paid)
            rng.shuffle(order)
            sides = {"D": iter(mine), "P": iter(paid)}
            events += [next(sides[o]) for o in order]
    # Ids are unique over all agreements and rise in the order of arrival.
    return [(kind, agreement, n, amount) for n, (kind, agreement, _, amount) in enumerate(events)]


def frames(spark, events):
    documents = [(n, None, 1, a[1], a[0], amount) for kind, a, n, amount in events if kind == "DOCUMENT"]
    bundles = [(n, a[1], a[0], amount) for kind, a, n, amount in events if kind == "PAYMENT"]
    return spark.createDataFrame(documents, DOCUMENTS), spark.createDataFrame(bundles, BUNDLES)


def check(result, documents, expected):
    allocated, open_documents, leftovers = expected
    got = rows(
        result.allocations, "id_client", "cooperation_agreement_no", "id_payment_document", "id_payment_bundle",
        "allocated",
    )
    assert got == sorted(allocated, key=lambda r: tuple((False, str(v)) for v in r))
    left = {n: amount for queue in open_documents.values() for n, amount in queue.items()}
    assert dict(rows(result.documents_after, "id_payment_document", "amount")) == left
    assert sorted(rows(result.leftovers)) == sorted(leftovers)
    assert result.documents_after.columns == documents.columns

    # Money is kept: what is allocated came from payments and went to documents.
    given = sum(r[-1] for r in got)
    total = {name: frame.agg(F.sum(column)).first()[0] for name, frame, column in (
        ("owed", documents, "amount"), ("open", result.documents_after, "amount"))}
    assert given + total["open"] == total["owed"]


# With 23 blocks many agreements lie in more than one.
@pytest.mark.parametrize("blocks", [1, 23])
def test_batch_matches_a_loop(spark, blocks):
    events = random_events(11, agreements=60, documents_first=True)
    documents, bundles = frames(spark, events)
    check(allocate_payments(documents, bundles, blocks), documents, settle(events))


def test_cases(spark):
    """Exact, under-, over- and zero payment of documents of 60, 0 and 90: one agreement each."""
    payments = {1: [100, 50], 2: [70], 3: [200, 9], 4: [0]}
    documents = spark.createDataFrame(
        [(10 * a + i, None, i, a, 5, amount) for a in payments for i, amount in enumerate([60, 0, 90])], DOCUMENTS
    )
    bundles = spark.createDataFrame(
        [(10 * a + i, a, 5, amount) for a, paid in payments.items() for i, amount in enumerate(paid)], BUNDLES
    )
    result = allocate_payments(documents, bundles)
    assert sorted(rows(result.allocations, "id_payment_document", "id_payment_bundle", "allocated")) == [
        (10, 10, 60), (12, 10, 40), (12, 11, 50),
        (20, 20, 60), (22, 20, 10),
        (30, 30, 60), (32, 30, 90),
    ]
    assert dict(rows(result.documents_after.where("amount > 0"), "id_payment_document", "amount")) == {
        22: 80, 40: 60, 42: 90,
    }
    assert dict(rows(result.leftovers, "id_payment_bundle", "leftover")) == {30: 50, 31: 9}


def test_documents_without_a_client_or_agreement_are_kept(spark):
    documents = spark.createDataFrame([(1, None, 1, 1, None, 50), (2, None, 1, None, 7, 30), (3, None, 1, 1, 7, 20)], DOCUMENTS)
    bundles = spark.createDataFrame([(1, 1, 7, 5)], BUNDLES)
    after = allocate_payments(documents, bundles, 3).documents_after
    assert rows(after, "id_payment_document", "amount") == [(1, 50), (2, 30), (3, 15)]


def test_blocks_equal_windows(spark):
    numbers = spark.range(3000).select(
        (F.col("id") % 3).alias("k"),
        F.shiftrightunsigned(F.xxhash64("id"), 4).alias("o"),
        (F.col("id") * 37 % 101).alias("v"),
    )
    aggregates = [
        Running("total", F.col("v")),
        Running("top", F.col("v"), "max"),
        Running("top_before", F.col("v"), "max", inclusive=False),
    ]
    window = Window.partitionBy("k").orderBy("o")
    plain = rows(
        numbers.select(
            "*", *[a.aggregate(a.value).over(window.rowsBetween(*a.frame)).alias(a.out) for a in aggregates]
        )
    )
    for blocks in (1, 2, 13):
        assert rows(running(numbers, ["k"], ["o"], aggregates, blocks)) == plain


def test_a_hot_agreement_on_few_days_is_many_blocks(spark):
    rng = random.Random(5)
    kinds = [rng.choice(["DOCUMENT", "PAYMENT"]) for _ in range(4000)]
    events = [(kind, (1, 1), n, rng.randint(0, 50)) for n, kind in enumerate(kinds)]
    data = [(a[0], a[1], kind, n, amount, n // 1500) for kind, a, n, amount in events]
    log = spark.createDataFrame(data, arrivals.EVENT_SCHEMA)
    assert in_blocks(log, ["id_client"], ["arrival", "id"], 8).select(BLOCK).distinct().count() >= 6
    placed = arrivals.place_events(log, 8)
    allocated, _, leftovers = settle(events)
    assert sorted(rows(arrivals.allocations(placed, 8))) == sorted(allocated)
    assert sorted(rows(arrivals.leftovers(placed))) == sorted(leftovers)


@pytest.mark.parametrize("blocks", [1, 23])
def test_log_of_mixed_arrivals_matches_a_loop(spark, blocks):
    events = random_events(17, agreements=60, documents_first=False)
    data = [(a[0], a[1], kind, n, amount, n) for kind, a, n, amount in events]
    placed = arrivals.place_events(spark.createDataFrame(data, arrivals.EVENT_SCHEMA), blocks)
    allocated, _, leftovers = settle(events)
    assert leftovers, "the case must drop money"
    assert sorted(rows(arrivals.allocations(placed, blocks))) == sorted(allocated)
    assert sorted(rows(arrivals.leftovers(placed))) == sorted(leftovers)


def run_stream(spark, tmp_path, events, batches):
    """Feed the events as that many files, one file to a batch."""
    source = tmp_path / "events"
    data = [(a[0], a[1], kind, n, amount, n) for kind, a, n, amount in events]
    size = -(-len(data) // batches)
    for i in range(0, len(data), size):
        part = spark.createDataFrame(data[i : i + size], arrivals.EVENT_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(arrivals.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    out, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    streaming.record_arrivals(stream, out, checkpoint, once=True).awaitTermination()
    return spark.read.parquet(out)


def test_stream_matches_batch_when_documents_come_first(spark, tmp_path):
    events = random_events(3, agreements=15, documents_first=True)
    documents, bundles = frames(spark, events)
    expected = allocate_payments(documents, bundles)
    log = run_stream(spark, tmp_path, events, batches=2)
    assert rows(arrivals.allocations(log)) == rows(expected.allocations)
    assert rows(arrivals.leftovers(log)) == rows(expected.leftovers)


def test_stream_matches_a_loop_when_arrivals_mix(spark, tmp_path):
    rng = random.Random(8)
    events = random_events(21, agreements=15, documents_first=False)
    allocated, _, leftovers = settle(events)
    assert leftovers, "the case must drop money"
    log = run_stream(spark, tmp_path, events, batches=rng.randint(3, 4))
    assert sorted(rows(arrivals.allocations(log))) == sorted(allocated)
    assert sorted(rows(arrivals.leftovers(log))) == sorted(leftovers)


def test_stream_state_is_written_anew_every_few_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streaming, "COMPACT_EVERY", 2)
    events = random_events(17, agreements=12, documents_first=False)
    allocated, _, leftovers = settle(events)
    log = run_stream(spark, tmp_path, events, batches=6)
    assert sorted(rows(arrivals.allocations(log))) == sorted(allocated)
    assert sorted(rows(arrivals.leftovers(log))) == sorted(leftovers)
    assert (tmp_path / "log-state/full/batch_id=4").exists()
    last = streaming.state_before(spark, str(tmp_path / "log-state"), 6)
    owed = {}
    for kind, agreement, _, amount in events:
        owed[agreement] = owed.get(agreement, 0) + (amount if kind == "DOCUMENT" else 0)
    assert {(r.id_client, r.cooperation_agreement_no): r.owed_before for r in last.collect()} == owed


@pytest.mark.parametrize("blocks", [None, 4])
def test_events_without_a_client_or_agreement_are_placed(spark, blocks):
    events = [
        (1, 1, "DOCUMENT", 1, 50, 1), (1, 1, "PAYMENT", 2, 80, 2), (None, 1, "DOCUMENT", 3, 9, 1),
        (None, 1, "PAYMENT", 4, 7, 2), (1, None, "PAYMENT", 5, 6, 1), (None, None, "DOCUMENT", 6, 5, 1), (None, None, "PAYMENT", 7, 0, 3),
    ]
    log = spark.createDataFrame(events, arrivals.EVENT_SCHEMA)
    before = spark.createDataFrame([(1, 1, 10, 10)], "id_client long, cooperation_agreement_no long, owed_before long, paid_before long")
    for state in (None, before):
        placed = arrivals.place_events(log, blocks, state)
        assert placed.count() == len(events)
        assert rows(arrivals.leftovers(placed), "id_payment_bundle", "leftover") == [(2, 30), (4, 7), (5, 6)]
        assert rows(arrivals.allocations(placed, blocks), "id_payment_document", "id_payment_bundle", "allocated") == [(1, 2, 50)]
