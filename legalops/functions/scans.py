"""Running aggregates whose groups may be larger than a task can hold.

A plain window sorts each group in one task. Here rows are range-partitioned by group
and order, so that all partitions are of like size and a large group is cut into blocks
by its number of rows, whatever its order values are. Each block is scanned on its own,
and what the earlier blocks of its group come to is carried in. A group of one block
has nothing to carry. There is one path for groups of every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legalops.session import shared_folder
from legalops.sources.tables import stage

BLOCK = "_block"


@dataclass(frozen=True)
class Running:
    """One running aggregate: `how` is "sum" or "max" of `value`, named `out`.

    It takes in the row itself unless `inclusive` is False.
    """

    out: str
    value: Column
    how: str = "sum"
    inclusive: bool = True

    @property
    def frame(self) -> tuple[int, int]:
        return Window.unboundedPreceding, 0 if self.inclusive else -1

    def aggregate(self, column: Column) -> Column:
        return F.sum(column) if self.how == "sum" else F.max(column)

    def combine(self, carried: Column, own: Column) -> Column:
        if self.how == "sum":
            return F.coalesce(carried, F.lit(0)) + F.coalesce(own, F.lit(0))
        return F.greatest(carried, own)


def in_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """The rows with the number of their block, written out so that a block stays as it is.

    Blocks are the partitions of a sampled range partitioning by keys and order: their
    numbers rise along each group. `blocks` sets how many there are, by default as many
    as the session's shuffle partitions.
    """
    count = [blocks] if blocks else []
    ranged = df.repartitionByRange(*count, *keys, *order).withColumn(BLOCK, F.spark_partition_id())
    return stage(ranged, shared_folder(df.sparkSession, "blocks"))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggregates: Sequence[Running],
    blocks: int | None = None,
) -> DataFrame:
    """Add running aggregates over `keys`, in the order of `order`."""
    held = in_blocks(
        df.select("*", *[a.value.alias(f"_value_{a.out}") for a in aggregates]), keys, order, blocks
    )
    return scan_blocks(held, keys, order, aggregates).select(*df.columns, *[a.out for a in aggregates])


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on keys where null equals null; the left side's keys are kept."""
    named = right.select(*[F.col(k).alias(f"_right_{k}") if k in keys else F.col(k) for k in right.columns])
    same = [left[k].eqNullSafe(named[f"_right_{k}"]) for k in keys]
    return left.join(named, same, how).drop(*[f"_right_{k}" for k in keys])


def of_cut_groups(held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the groups at an end of a block, which are all that have rows in several.

    Blocks follow each other in the order of the keys, so a group that goes on from one to
    the next is the last of the one and the first of the other. There are two such groups
    a block, few enough to broadcast, and nothing is shuffled to find them.
    """
    if not keys:
        return held
    key = F.struct(*keys)
    ends = held.groupBy(BLOCK).agg(F.min(key).alias("first"), F.max(key).alias("last"))
    groups = ends.select(F.explode(F.array("first", "last")).alias("key")).distinct().select("key.*")
    return null_safe_join(held, F.broadcast(groups), keys)


def scan_blocks(
    held: DataFrame, keys: Sequence[str], order: Sequence[str], aggregates: Sequence[Running]
) -> DataFrame:
    """Running aggregates of `_value_` columns over rows that have their block."""
    totals = of_cut_groups(held, keys).groupBy(*keys, BLOCK).agg(
        *[a.aggregate(F.col(f"_value_{a.out}")).alias(f"_value_{a.out}") for a in aggregates]
    )
    # A group has at most one row per partition here, and all groups together two a block.
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, BLOCK, *[a.aggregate(F.col(f"_value_{a.out}")).over(before).alias(f"_carry_{a.out}") for a in aggregates]
    )
    inside = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    joined = null_safe_join(held, F.broadcast(carried), [*keys, BLOCK], "left")
    for a in aggregates:
        own = a.aggregate(F.col(f"_value_{a.out}")).over(inside.rowsBetween(*a.frame))
        joined = joined.withColumn(a.out, a.combine(F.col(f"_carry_{a.out}"), own))
    return joined
