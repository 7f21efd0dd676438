"""What the operators of this subpackage share: staged steps, row keys, shipped code."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legalops.session import shared_folder
from legalops.sources.tables import stage

# White space of the contracts, as Java and Python regular expressions write it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Keys of rows without an id lie above this bound, ids of rows below it.
NO_ID = 1 << 62


def ship(module: str) -> None:
    """Send this module's functions by value, so that executors need not import it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step that is read again to the folder all executors share."""
    return stage(df, shared_folder(df.sparkSession, purpose))


def row_key(id_col: str, content: Column) -> Column:
    """The id as a long; where it is null, a key made from the row's content.

    Rows without an id thus keep apart from each other in joins unless they are equal.
    Their keys are larger than every id, so they never stand for a row that has one.
    """
    made = F.shiftrightunsigned(F.xxhash64(content), 2).bitwiseOR(F.lit(NO_ID))
    return F.coalesce(F.col(id_col).cast("long"), made)


def id_of(key: Column) -> Column:
    """The id behind a row key, null for rows without one."""
    return F.when(key < NO_ID, key)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not have."""
    while wanted in df.columns:
        wanted += "_"
    return wanted


def with_fields(df: DataFrame, made: Column, names: list[str]) -> DataFrame:
    """Add the fields of a struct as columns, replacing columns of the same names."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    held = free_name(df, "_made")
    return df.select(*kept, made.alias(held)).select(*kept, *[F.col(held)[n].alias(n) for n in names])


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send at most so many rows at once to Python in what runs inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)
