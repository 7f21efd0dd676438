"""Money is whole units in long columns; these are the two ways it gets rounded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_money_nearest(amount: Column) -> Column:
    """Round to a whole unit, halves to the even neighbour."""
    return F.rint(amount).cast("long")


def to_money_floor(amount: Column) -> Column:
    return F.floor(amount).cast("long")
