"""Tables stored in buckets of the agreement, so that joins on it move no rows.

Lines, assignments, cooperations and documents all name their client and cooperation.
Written in the same number of buckets of these two columns, sorted by them, bucket k of
one table meets bucket k of another in one task: a merge join, and an aggregate over the
two columns, then need no exchange. A join on more columns is co-located, too, as equal
keys agree on these two; Spark makes use of that where
spark.sql.requireAllClusterKeysForCoPartition is false, as in `session.SETTINGS`.

Buckets are known to the session's catalogue. A session that did not write them names
them with `attach_buckets`; the files stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legalops.model import TABLES
from legalops.sources.tables import Tables

AGREEMENT_COLUMNS = ("id_client", "cooperation_agreement_no")
AGREEMENT_TABLES = ("cooperation_agreement", "assignment_agreement", "contract_service", "payment_document")


def bucketed_name(name: str, prefix: str) -> str:
    return f"{prefix}_{name}"


def write_buckets(
    t: Tables,
    root: str,
    prefix: str,
    buckets: int,
    names: Sequence[str] = AGREEMENT_TABLES,
    columns: Sequence[str] = AGREEMENT_COLUMNS,
) -> None:
    """Write tables under `root` in buckets, as catalogue tables called prefix_name.

    Rows are dealt by the hash that buckets go by before they are written, so each bucket
    is one file, and sorted in it. Rows with a null in `columns` go to a bucket as well.
    Choose `buckets` so that the largest table's fit a task; all tables need the same.
    """
    for name in names:
        laid_out = t[name].select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].schema.fields])
        (
            laid_out.repartition(buckets, *columns)
            .write.mode("overwrite")
            .format("parquet")
            .option("path", f"{root}/{name}")
            .bucketBy(buckets, *columns)
            .sortBy(*columns)
            .saveAsTable(bucketed_name(name, prefix))
        )


def attach_buckets(
    spark: SparkSession,
    root: str,
    prefix: str,
    buckets: int,
    names: Sequence[str] = AGREEMENT_TABLES,
    columns: Sequence[str] = AGREEMENT_COLUMNS,
) -> None:
    """Name buckets that another session wrote, without reading them."""
    by = ", ".join(columns)
    for name in names:
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[name].schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {bucketed_name(name, prefix)} ({fields}) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{root}/{name}'"
        )


def read_buckets(spark: SparkSession, prefix: str, names: Sequence[str] = AGREEMENT_TABLES) -> dict[str, DataFrame]:
    return {name: spark.table(bucketed_name(name, prefix)) for name in names}


def agreement_ledger(t: Tables) -> DataFrame:
    """One row per assignment of a known cooperation: its dates, manager, lines and what they come to.

    Assignments without lines have 0 of both. Lines are added up by their whole key, which
    holds the bucket columns, so over bucketed tables neither join and neither aggregate
    has an exchange. The hint keeps a small side from being broadcast, which would move it.
    """
    key = list(TABLES["assignment_agreement"].primary_key)
    lines = t["contract_service"].groupBy(*key).agg(F.count("*").alias("lines"), F.sum("price").alias("charged"))
    cooperations = t["cooperation_agreement"].select(*AGREEMENT_COLUMNS, "manager_number", "start_date")
    return (
        t["assignment_agreement"]
        .select(*key, "created_at")
        .join(lines.hint("merge"), key, "left")
        .join(cooperations.hint("merge"), list(AGREEMENT_COLUMNS))
        .select(
            *key,
            "manager_number",
            "start_date",
            "created_at",
            F.coalesce("lines", F.lit(0)).alias("lines"),
            F.coalesce("charged", F.lit(0)).alias("charged"),
        )
    )


def agreement_balances(t: Tables) -> DataFrame:
    """One row per cooperation: assignments, lines, charged, and documents' amounts, without an exchange over buckets."""

    def totals(name: str, **aggregates) -> DataFrame:
        return t[name].groupBy(*AGREEMENT_COLUMNS).agg(*[a.alias(n) for n, a in aggregates.items()]).hint("merge")

    made = t["cooperation_agreement"].select(*AGREEMENT_COLUMNS, "manager_number")
    made = made.join(totals("assignment_agreement", assignments=F.count("*")), list(AGREEMENT_COLUMNS), "left")
    made = made.join(totals("contract_service", lines=F.count("*"), charged=F.sum("price")), list(AGREEMENT_COLUMNS), "left")
    made = made.join(totals("payment_document", billed=F.sum("amount")), list(AGREEMENT_COLUMNS), "left")
    counts = ("assignments", "lines", "charged", "billed")
    return made.select(*AGREEMENT_COLUMNS, "manager_number", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
