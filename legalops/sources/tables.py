"""Reading and writing the 19 tables as Parquet folders under one root.

Rows are never changed in place. A change is a new frame (`insert_ignore`,
`update_rows`) written to a new root that readers are then pointed at, or an
append, or an overwrite of whole month folders, which makes a repeat harmless.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legalops.functions.dates import day, month_start
from legalops.model import KIND_PARTITIONS, MONTH_PARTITIONS, TABLES
from legalops.session import shared_folder

Tables = Mapping[str, DataFrame]

MONTH = "month"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan one table with its declared schema; month-stored tables also have `month`."""
    return read_folder(spark, f"{root}/{name}", name)


def read_folder(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = T.StructType(list(TABLES[name].schema.fields))
    if name in MONTH_PARTITIONS:
        schema = schema.add(MONTH, T.DateType())
    # Folder columns come last in a scan.
    return spark.read.schema(schema).parquet(folder).select(*schema.names)


def read_tables(spark: SparkSession, root: str, names: Sequence[str] = tuple(TABLES)) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name) for name in names}


def _laid_out(df: DataFrame, name: str) -> DataFrame:
    """The declared columns in order, with the month folder column where there is one."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].schema.fields]
    if name in MONTH_PARTITIONS:
        columns.append(month_start(F.col(MONTH_PARTITIONS[name])).alias(MONTH))
    return df.select(*columns)


def _write(df: DataFrame, folder: str, name: str, mode: str, options: dict[str, str]) -> None:
    writer = _laid_out(df, name).write.mode(mode).options(**options)
    if name in MONTH_PARTITIONS:
        writer = writer.partitionBy(MONTH, *KIND_PARTITIONS.get(name, ()))
    writer.parquet(folder)


def write_folder(df: DataFrame, folder: str, name: str) -> None:
    """Write a table's rows to a folder of its own, in place of what is there."""
    _write(df, folder, name, "overwrite", {"partitionOverwriteMode": "static"})


def append_rows(df: DataFrame, root: str, name: str) -> None:
    """Add rows to a table in bulk."""
    _write(df, f"{root}/{name}", name, "append", {})


def reload_table(df: DataFrame, root: str, name: str) -> None:
    """Empty a table and load it again.

    The rows are written beside the table and then take its place, so `df` may read the
    table itself, and a load that fails leaves it as it was. For a moment there is no
    table: where readers must not notice, use `versions.replace_tables`.
    """
    load = uuid.uuid4().hex
    fresh, gone = f"{root}/_{name}-new-{load}", f"{root}/_{name}-old-{load}"
    write_folder(df, fresh, name)
    _swap(df.sparkSession, f"{root}/{name}", fresh, gone)


def _swap(spark: SparkSession, folder: str, fresh: str, gone: str) -> None:
    """Put the fresh folder in the place of a folder, which is deleted where there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    old = files.exists(path(folder))
    if old and not files.rename(path(folder), path(gone)):
        raise OSError(f"cannot move {folder}")
    if not files.rename(path(fresh), path(folder)):
        if old:
            files.rename(path(gone), path(folder))
        raise OSError(f"cannot move {fresh} to {folder}")
    spark.catalog.refreshByPath(folder)
    if old:
        files.delete(path(gone), True)


def reload_tables(t: Tables, root: str) -> None:
    for name in TABLES:
        if name in t:
            reload_table(t[name], root, name)


def replace_months(df: DataFrame, root: str, name: str) -> None:
    """Overwrite just the month folders (and kinds in them) that `df` has rows for."""
    if name not in MONTH_PARTITIONS:
        raise ValueError(f"{name} is not stored by month")
    _write(df, f"{root}/{name}", name, "overwrite", {"partitionOverwriteMode": "dynamic"})


def in_date_range(df: DataFrame, column: str, first: dt.date, after: dt.date) -> DataFrame:
    """Rows with first <= column < after; prunes month folders where the table has them."""
    df = df.where((F.col(column) >= day(first)) & (F.col(column) < day(after)))
    if MONTH in df.columns:
        df = df.where((F.col(MONTH) >= day(first.replace(day=1))) & (F.col(MONTH) < day(after)))
    return df


def new_rows(candidates: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key is not taken yet, one row per key."""
    return candidates.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")


def insert_ignore(existing: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after inserting the candidates and ignoring those whose key is taken."""
    return existing.unionByName(new_rows(candidates, existing, keys).select(*existing.columns))


def update_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The table after setting `columns` from the update with the same key, if there is one.

    `updates` holds at most one row per key. A matched NULL leaves the old value.
    """
    fresh = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(fresh, list(keys), "left")
    return joined.select(
        *[
            F.coalesce(f"_new_{c}", target[c]).alias(c) if c in columns else joined[c]
            for c in target.columns
        ]
    )


def update_in_place(
    spark: SparkSession, root: str, name: str, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> list[dt.date | None]:
    """Set `columns` of a month-stored table's rows from the updates with their keys.

    As `update_rows`, but only folders with a row to update are written again; the files
    of the others stay. The rows' months are found first, by keys alone: where the date
    that names the folder is a key, from the updates themselves, else from a scan of the
    key columns. Updates without a row change nothing. Gives the months written.
    """
    if name not in MONTH_PARTITIONS:
        raise ValueError(f"{name} is not stored by month")
    date = MONTH_PARTITIONS[name]
    inside = [date, *KIND_PARTITIONS.get(name, ())]
    if set(columns) & {*inside, *keys}:
        raise ValueError("keys and what names a folder cannot be updated")
    table = read_table(spark, root, name)
    parts = [MONTH, *KIND_PARTITIONS.get(name, ())]
    wanted = updates.select(*keys).distinct()
    if date in keys:
        # The updates' own months prune the scan.
        months = [r[0] for r in wanted.select(month_start(F.col(date))).distinct().collect()]
        table = table.where(F.col(MONTH).isin([m for m in months if m is not None]))
    # At most one row for each folder of the table.
    touched = [tuple(r) for r in table.select(*keys, *[F.col(p).alias(f"_part{i}") for i, p in enumerate(parts)]).join(wanted, list(keys), "left_semi").select(*[f"_part{i}" for i in range(len(parts))]).distinct().collect()]
    if not touched:
        return []
    in_folder = F.lit(False)
    for values in touched:
        here = F.lit(True)
        for part, value in zip(parts, values):
            here = here & F.col(part).eqNullSafe(F.lit(value))
        in_folder = in_folder | here
    fresh = update_rows(table.where(in_folder), updates, keys, columns)
    # What is read is written over, so the new rows are staged first.
    fresh = stage(fresh.drop(MONTH), shared_folder(spark, f"update-{name}"))
    replace_months(fresh, root, name)
    spark.catalog.refreshByPath(f"{root}/{name}")
    return sorted({values[0] for values in touched}, key=lambda m: (m is not None, m))


def stage(df: DataFrame, folder: str, **options: str) -> DataFrame:
    """Write a step to a shared folder and go on from the written files."""
    df.write.mode("overwrite").options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
