"""Streams that fail between sinks, and events that come late."""

from __future__ import annotations

import random

import pytest

from legalops.operators import arrivals
from legalops.streaming import allocation as streaming
from legalops.streaming import sink
from tests.conftest import rows
from tests.test_allocation import settle


def test_a_batch_that_fails_between_sinks_shows_in_none(spark, tmp_path, monkeypatch):
    data, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    real, names = sink.write_batch, ("even", "odd", "all")

    def split(df, batch_id):
        sink.write_sinks({"even": df.where("id % 2 = 0"), "odd": df.where("id % 2 = 1"), "all": df}, out, batch_id)

    def run():
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(data)
        sink.start(stream, split, checkpoint, once=True).awaitTermination()

    def seen():
        return {name: rows(df, "id") for name, df in sink.read_sinks(spark, out, names).items()}

    assert sink.read_sinks(spark, out, names) is None
    spark.range(0, 4).coalesce(1).write.mode("append").parquet(data)
    run()
    first = seen()
    assert first == {"even": [(0,), (2,)], "odd": [(1,), (3,)], "all": [(0,), (1,), (2,), (3,)]}

    def broken(df, folder, batch_id):
        if folder.endswith("odd") and batch_id == 1:
            raise OSError("disk full")
        real(df, folder, batch_id)

    monkeypatch.setattr(sink, "write_batch", broken)
    spark.range(4, 8).coalesce(1).write.mode("append").parquet(data)
    with pytest.raises(Exception, match="disk full"):
        run()
    # The first sink has the batch's files, but nobody sees them.
    assert spark.read.parquet(f"{out}/even").count() == 4
    assert seen() == first
    monkeypatch.setattr(sink, "write_batch", real)
    run()
    assert {name: len(found) for name, found in seen().items()} == {"even": 4, "odd": 4, "all": 8}
    # A marked batch that runs again is not written again.
    sink.write_sinks({name: spark.range(1) for name in names}, out, 1)
    assert len(seen()["all"]) == 8


def _log(seed, lateness):
    """Events (client, agreement, kind, id, amount, arrival), and the same in the order in which they come."""
    rng = random.Random(seed)
    events = []
    for n in range(160):
        agreement = (1, 1) if rng.random() < 0.4 else (rng.randrange(1, 5), rng.randrange(1, 3))
        kind = rng.choice(["DOCUMENT", "DOCUMENT", "PAYMENT"])
        events.append((*agreement, kind, n + 1, rng.choice([0, 5, 20, 35]), n))
    return events, sorted(events, key=lambda e: (e[5] + rng.randrange(lateness), e[3]))


def _run(spark, tmp_path, batches, lateness):
    data, out = str(tmp_path / "events"), str(tmp_path / "log")
    for batch in batches:
        spark.createDataFrame(batch, arrivals.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(data)
        stream = spark.readStream.schema(arrivals.EVENT_SCHEMA).parquet(data)
        streaming.record_arrivals(stream, out, f"{out}-checkpoint", once=True, lateness=lateness).awaitTermination()
    return out


def test_a_shuffled_log_is_placed_like_the_ordered_one(spark, tmp_path):
    lateness = 25
    events, coming = _log(4, lateness)
    cuts = [0, 50, 51, 110, len(coming)]
    out = _run(spark, tmp_path, [coming[a:b] for a, b in zip(cuts, cuts[1:])], lateness)
    placed = streaming.placed_so_far(spark, out)
    want = arrivals.place_events(spark.createDataFrame(events, arrivals.EVENT_SCHEMA))
    assert rows(placed) == rows(want.select(*placed.columns))
    assert streaming.late_events(spark, out).count() == 0
    # Placed without waiting, the same log goes wrong.
    other = _run(spark, tmp_path / "other", [coming[a:b] for a, b in zip(cuts, cuts[1:])], None)
    assert rows(spark.read.schema(arrivals.PLACED_SCHEMA).option("basePath", other).parquet(other).select(*want.columns)) != rows(want)
    allocated, _, _ = settle([(kind, (c, a), n, amount) for c, a, kind, n, amount, _ in events])
    assert sorted(rows(arrivals.allocations(placed))) == sorted(allocated)


def test_events_beyond_the_lateness_are_kept_apart(spark, tmp_path):
    batches = [[(1, 1, "DOCUMENT", 1, 50, 100)], [(1, 1, "PAYMENT", 2, 20, 111)], [(1, 1, "DOCUMENT", 3, 9, 101), (1, 1, "PAYMENT", 4, 5, 102)]]
    out = _run(spark, tmp_path, batches, 10)
    assert rows(streaming.late_events(spark, out), "id", "batch_id") == [(3, 2)]
    assert rows(arrivals.allocations(streaming.placed_so_far(spark, out)), "id_payment_bundle", "allocated") == [(2, 20), (4, 5)]
