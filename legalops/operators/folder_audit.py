"""Audits of month-stored tables that are kept up folder by folder.

What a rule finds in a folder is a count and a least failing key, and both merge: counts
add up, of keys the least stays. So each month folder has a written summary, and an audit
reads only the folders that changed since theirs was written. Rules that look at one row
can be kept so, and keys that hold the date by which rows are stored, since rows with one
such key lie in one folder. Other keys and references need the whole table
(`operators.quality`).
"""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legalops.model import MONTH_PARTITIONS, TABLES
from legalops.operators.quality import SLOTS, key_text, key_text_of_slots, row_rules, typed_key
from legalops.sources.tables import MONTH, read_table

# The folder of rows without a date.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
KINDS = ("nulls", "checks", "identifiers")


def folder_stamps(spark: SparkSession, root: str, name: str) -> dict[str, str]:
    """For each month folder a text that changes when its files do."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    top = path(f"{root}/{name}")
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[str]] = {}
    if files.exists(top):
        listed = files.listFiles(top, True)
        while listed.hasNext():
            status = listed.next()
            parts = status.getPath().toString().split("/")
            month = next((unquote(p.split("=", 1)[1]) for p in parts if p.startswith(f"{MONTH}=")), None)
            if month is not None and not parts[-1].startswith(("_", ".")):
                found.setdefault(month, []).append(f"{parts[-1]} {status.getLen()} {status.getModificationTime()}")
    return {month: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for month, names in found.items()}


def kept_rules(name: str) -> list[str]:
    """The rules of a table that its folders' summaries hold."""
    table, date = TABLES[name], MONTH_PARTITIONS[name]
    keys = [f"primary key ({', '.join(table.primary_key)})"] if date in table.primary_key else []
    return [rule for rule, _ in row_rules(table, KINDS)] + keys


def _in_months(months: list[str]) -> Column:
    dated = [m for m in months if m != NO_MONTH]
    inside = F.col(MONTH).isin([F.lit(m).cast("date") for m in dated]) if dated else F.lit(False)
    return inside | F.col(MONTH).isNull() if NO_MONTH in months else inside


def _summaries(rows: DataFrame, name: str) -> DataFrame:
    """month, rule, failing_rows and sample_key for what the rules find in some folders."""
    table = TABLES[name]
    broken = ", ".join(f"CASE WHEN {sql} THEN '{rule}' END" for rule, sql in row_rules(table, KINDS))
    any_broken = " OR ".join(f"({sql})" for _, sql in row_rules(table, KINDS))
    found = rows.where(any_broken).selectExpr(MONTH, f"explode(array_compact(array({broken}))) AS rule", "1L AS rows", f"{key_text(table.primary_key)} AS key")
    if MONTH_PARTITIONS[name] in table.primary_key:
        key = table.primary_key
        counted = rows.selectExpr(MONTH, *typed_key(table, key).split(", ")).groupBy(MONTH, *SLOTS).agg(F.count("*").alias("rows"))
        repeated = counted.where("rows > 1").select(
            MONTH, F.lit(f"primary key ({', '.join(key)})").alias("rule"), "rows", F.expr(key_text_of_slots(table, key)).alias("key")
        )
        found = found.unionByName(repeated)
    return found.groupBy(MONTH, "rule").agg(F.sum("rows").alias("failing_rows"), F.min("key").alias("sample_key"))


def audit_changed_folders(spark: SparkSession, root: str, name: str, summaries: str) -> list[str]:
    """Bring the summaries of a stored table up to date; gives the months that were read.

    A folder is read if its files are not those its summary was made of. Files that come
    while it is read are seen by the next audit: the stamp is taken before.
    """
    stamps = folder_stamps(spark, root, name)
    known = {r["folder"]: r["stamp"] for r in _stored(spark, summaries, name, "folders").collect()}  # one row a folder
    todo = sorted(m for m, stamp in stamps.items() if known.get(m) != stamp)
    if not todo:
        return []
    rows = read_table(spark, root, name).where(_in_months(todo))
    found = _summaries(rows, name).withColumn("folder", F.coalesce(F.col(MONTH).cast("string"), F.lit(NO_MONTH))).drop(MONTH)
    marks = spark.createDataFrame([(m, stamps[m]) for m in todo], "folder string, stamp string")
    every = marks.select("*", F.explode(F.array(*[F.lit(r) for r in kept_rules(name)])).alias("rule"))
    whole = every.join(found, ["folder", "rule"], "left").withColumn("failing_rows", F.coalesce("failing_rows", F.lit(0)))
    # A folder's stamp is written after what it vouches for.
    for part, df in (("findings", whole.drop("stamp")), ("folders", marks)):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(f"{summaries}/{name}/{part}")
        spark.catalog.refreshByPath(f"{summaries}/{name}/{part}")
    return todo


FIELDS = {"findings": "rule string, failing_rows long, sample_key string, folder string", "folders": "stamp string, folder string"}


def _stored(spark: SparkSession, summaries: str, name: str, part: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path
    at = path(f"{summaries}/{name}/{part}")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], FIELDS[part])
    folder = F.coalesce("folder", F.lit(NO_MONTH)).alias("folder")
    names = [f.split()[0] for f in FIELDS[part].split(", ")[:-1]]
    return spark.read.schema(FIELDS[part]).parquet(at.toString()).select(*names, folder)


def audit_by_folder(spark: SparkSession, root: str, name: str, summaries: str) -> DataFrame:
    """The kept rules' findings over a whole stored table, of which only changed folders are read.

    As `quality.audit`: table_name, rule, failing_rows and the least failing key. Folders
    that the table no longer has do not count.
    """
    if name not in MONTH_PARTITIONS:
        raise ValueError(f"{name} is not stored by month")
    audit_changed_folders(spark, root, name, summaries)
    present = list(folder_stamps(spark, root, name))
    found = _stored(spark, summaries, name, "findings").where(F.col("folder").isin(present) if present else F.lit(False))
    merged = found.groupBy("rule").agg(F.sum("failing_rows").alias("failing_rows"), F.min("sample_key").alias("sample_key"))
    names = spark.createDataFrame([(name, rule) for rule in kept_rules(name)], "table_name string, rule string")
    return names.join(merged, "rule", "left").select("table_name", "rule", F.coalesce("failing_rows", F.lit(0)).alias("failing_rows"), "sample_key")
