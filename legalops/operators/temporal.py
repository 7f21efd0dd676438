"""Joins by time: the last row on or before a date, and rows whose periods overlap.

Neither forms pairs that it then throws away. Both sides are laid along one line by key
and time, and a scan gives each row what lies before it. A scan in blocks
(`functions.scans`) cuts a key of any size; the join by the last row takes it only for keys
that are too large for a task, as it writes all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legalops.functions.scans import Running, running
from legalops.session import shared_folder, shuffles_dropped
from legalops.sources.tables import stage

# Starts that one block of an overlap join has; at most twice as many rows of it are
# looked at in vain for each period.
STARTS = 512

# Classes of keys for each task, counted to find keys that are too large for one.
CLASSES = 16


def _present(columns: Sequence[str]) -> Column:
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return present


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    date: str,
    right_date: str,
    columns: Sequence[str],
    blocks: int | None = None,
    dealt_by: Sequence[str] = (),
) -> DataFrame:
    """Every left row with `columns` of the last right row of its keys on or before its date.

    A left row without such a row, or with a null key or date, keeps nulls. Right rows with
    a null key or date are never found. Of right rows on one date that one is last whose
    `columns` are largest, so these must have an order. `keys` may be empty. The result has
    the left columns and then `columns`, whose names the left side must not have.

    Both sides are merged by key and date, right rows first on a day, and the right row
    seen last is a running maximum of (date, columns). Nothing is multiplied. The left side is
    written, and then each side is dealt by `dealt_by`, some of the keys and by default all,
    into `blocks` tasks, by default the session's shuffle partitions. A side that comes dealt
    so is not moved. Keys too large for a task are merged in blocks of rows instead, which
    takes three times the disk: those of classes of keys with more rows than a task's share.
    """
    taken = set(columns) & set(left.columns)
    if taken:
        raise ValueError(f"the left side has {', '.join(sorted(taken))} already")
    spark = left.sparkSession
    with shuffles_dropped(spark):
        left = stage(left, shared_folder(spark, "left"), compression="zstd")
    right = right.where(_present([*keys, right_date]))
    tasks = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key_class = F.pmod(F.xxhash64(*_common(left, right, keys)), F.lit(CLASSES * tasks)) if keys else F.lit(0).cast("long")
    large = _large(left, key_class, tasks) | _large(right, key_class, tasks)
    sides = left, right, keys, date, right_date, columns
    if not large:
        return _dealt(*sides, tasks, dealt_by or keys)
    in_blocks = key_class.isin(sorted(large))
    with shuffles_dropped(spark):
        cut = _in_blocks(left.where(in_blocks), right.where(in_blocks), *sides[2:], blocks)
    if not keys:
        return cut
    return _dealt(left.where(~in_blocks), right.where(~in_blocks), *sides[2:], tasks, dealt_by or keys).unionByName(cut)


def _common(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys in the type that both sides' values fit, as equal numbers of two types have two hashes."""
    both = left.select(*keys).union(right.select(*keys)).schema if keys else []
    return [F.col(k).cast(f.dataType) for k, f in zip(keys, both)]


def _large(rows: DataFrame, key_class: Column, tasks: int) -> set[int]:
    """The classes that have more rows than each of the tasks would, which are less than `tasks` many."""
    with shuffles_dropped(rows.sparkSession):
        counted = rows.groupBy(key_class.alias("class")).agg(F.count("*").alias("n"))
        share = F.col("n") * tasks > F.sum("n").over(Window.partitionBy())
        return {r["class"] for r in counted.select("class", share.alias("large")).where("large").collect()}


def _sides(
    left: DataFrame, right: DataFrame, keys: Sequence[str], date: str, right_date: str, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[Column]]:
    """Both sides with the same columns, `_key`s, `_date`, `_side`, `_row` and `_seen`, and the left columns again from these.

    A left column that is a key or the date of both sides' type is not in `_row` again.
    """
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    given = {k: k for k in keys}
    if date not in names:
        names[date], given[date] = "_date", right_date
    named = [k.alias(f"_key{i}") for i, k in enumerate(_common(left, right, keys))]
    held = [c for c in left.columns if c not in names or left.schema[c].dataType != right.schema[given[c]].dataType]
    payload = F.struct(F.col(right_date).alias("date"), *columns)
    merged = left.select(
        *named,
        F.col(date).alias("_date"),
        F.lit(1).alias("_side"),
        F.struct(*held).alias("_row") if held else F.struct(F.lit(1)).alias("_row"),
        F.lit(None).cast(right.select(payload.alias("seen")).schema["seen"].dataType).alias("_seen"),
    )
    seen = right.select(
        *named,
        F.col(right_date).alias("_date"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(merged.schema["_row"].dataType).alias("_row"),
        payload.alias("_seen"),
    )
    return merged, seen, [(F.col("_row")[c] if c in held else F.col(names[c])).alias(c) for c in left.columns]


def _dealt(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    date: str,
    right_date: str,
    columns: Sequence[str],
    tasks: int,
    dealt_by: Sequence[str],
) -> DataFrame:
    """The as-of join with all rows of a key in one task."""
    merged, seen, row = _sides(left, right, keys, date, right_date, columns)
    by = [f"_key{list(keys).index(k)}" for k in dealt_by]
    met = merged.repartition(tasks, *by).unionByName(seen.repartition(tasks, *by))
    before = Window.partitionBy(*[f"_key{i}" for i in range(len(keys))]).orderBy("_date", "_side")
    last = F.max("_seen").over(before.rowsBetween(Window.unboundedPreceding, 0))
    return met.withColumn("_last", last).where("_side = 1").select(*row, *[F.col("_last")[c].alias(c) for c in columns])


def _in_blocks(
    left: DataFrame, right: DataFrame, keys: Sequence[str], date: str, right_date: str, columns: Sequence[str], blocks: int | None
) -> DataFrame:
    """The as-of join with a key's rows cut into blocks."""
    merged, seen, row = _sides(left, right, keys, date, right_date, columns)
    found = running(
        merged.unionByName(seen),
        [f"_key{i}" for i in range(len(keys))],
        ["_date", "_side"],
        [Running("_last", F.col("_seen"), "max")],
        blocks,
    )
    return found.where("_side = 1").select(*row, *[F.col("_last")[c].alias(c) for c in columns])


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_period: tuple[str, str],
    right_period: tuple[str, str],
    blocks: int | None = None,
) -> DataFrame:
    """Pairs of rows with equal keys whose periods overlap: structs `left` and `right`.

    A period is (start, end): it holds its start and all before its end. A null end never
    comes. Rows with a null key or start, or whose end is not after their start, overlap
    nothing. Equal rows each make their own pairs. Periods may overlap each other on both
    sides.

    Two periods overlap where one of them starts inside the other, so there are two
    sweeps: left starts inside right periods, and right starts inside left periods but not
    at their start. In the order of starts, those inside a period are a run, from and up to
    places that a running count gives. A period then meets the blocks of starts its run
    goes through: the pairs come from an equi-join on (key, block), and all that it finds,
    but for the ends of runs, is result.
    """
    names = [f"_key{i}" for i in range(len(keys))]

    def side(df: DataFrame, period: tuple[str, str], name: str) -> DataFrame:
        start, end = (F.col(c) for c in period)
        usable = _present([*keys, period[0]]) & (end.isNull() | (end > start))
        made = df.where(usable).select(
            *[F.col(k).alias(n) for k, n in zip(keys, names)],
            start.alias("_start"),
            end.alias("_end"),
            F.struct(*df.columns).alias("_row"),
            F.monotonically_increasing_id().alias("_id"),
        )
        # Written, so that the numbers of the rows stay as they are.
        return stage(made, shared_folder(df.sparkSession, f"periods-{name}"))

    a, b = side(left, left_period, "left"), side(right, right_period, "right")
    first = _starts_inside(a, b, names, True, blocks).select(F.col("_point").alias("left"), F.col("_period").alias("right"))
    second = _starts_inside(b, a, names, False, blocks).select(F.col("_period").alias("left"), F.col("_point").alias("right"))
    return first.unionByName(second)


def _starts_inside(points: DataFrame, periods: DataFrame, keys: Sequence[str], at_start: bool, blocks: int | None) -> DataFrame:
    """Pairs (_point, _period) where a row of `points` starts inside a row of `periods`.

    With `at_start` also where both start together.
    """
    met = _met(points, periods, keys, at_start, blocks)
    return met.where((F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))).select("_point", "_period")


def _met(points: DataFrame, periods: DataFrame, keys: Sequence[str], at_start: bool, blocks: int | None) -> DataFrame:
    """Each period with the starts of all blocks that its run goes through."""
    # On one day ends come first, and starts of periods before or after those they count.
    bounds = F.array(
        F.struct(F.col("_start").alias("_at"), F.lit(1 if at_start else 3).alias("_place")),
        F.struct(F.col("_end").alias("_at"), F.lit(0).alias("_place")),
    )
    none = F.lit(None).cast("long")
    events = points.select(*keys, F.col("_start").alias("_at"), F.lit(2).alias("_place"), "_id").unionByName(
        periods.select(*keys, F.explode(bounds).alias("_bound"), "_id").select(*keys, "_bound.*", "_id").where("_at IS NOT NULL")
    )
    is_point = F.col("_place") == 2
    # The order is total, so a point has one rank.
    ranked = running(events, keys, ["_at", "_place", "_id"], [Running("_rank", is_point.cast("long"), "sum", False)], blocks)
    ranked = stage(ranked.select(*keys, "_place", "_id", "_rank"), shared_folder(events.sparkSession, "ranks"))

    ranks = ranked.where(is_point).select("_id", "_rank")
    starts = points.join(ranks, "_id").select(*keys, "_rank", F.floor(F.col("_rank") / STARTS).alias("_block"), F.col("_row").alias("_point"))
    low = F.max(F.when(F.col("_place").isin(1, 3), F.col("_rank")))
    high = F.max(F.when(F.col("_place") == 0, F.col("_rank")))
    runs = ranked.where(~is_point).groupBy("_id").agg(low.alias("_low"), high.alias("_high"))
    counted = points.groupBy(*keys).agg(F.count("*").alias("_all"))
    runs = periods.join(runs, "_id").join(counted, list(keys)).withColumn("_high", F.coalesce(F.when(F.col("_end").isNotNull(), F.col("_high")), "_all"))
    runs = runs.where("_low < _high").select(
        *keys,
        "_low",
        "_high",
        F.col("_row").alias("_period"),
        F.explode(F.sequence(F.floor(F.col("_low") / STARTS), F.floor((F.col("_high") - 1) / STARTS))).alias("_block"),
    )
    return starts.join(runs, [*keys, "_block"])
