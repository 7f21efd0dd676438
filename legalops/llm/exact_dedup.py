"""Exact duplicates by a content sort.

Rows are range-partitioned by sampled splitters and sorted, so that equal normalised
texts lie next to each other; each row's text is compared in full with the one before
it. The order is (first characters, hash, whole text, id): splitters hold only the
bounded leading parts, however long the texts are. The id is part of the order, so a
group of copies may run over many partitions; where a partition ends inside a group, its
last text is compared in full with the first text of the next one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from legalops.llm.common import SPACE, ship, small_batches, staged

ship(__name__)

# Leading characters of a text that a splitter holds.
LEAD = 24
# Rows sent to Python at once: equal texts lie together, and they may all be long.
BATCH_ROWS = 500
FIRST, LAST = 1, 2
OWN = [
    T.StructField("part", T.IntegerType()),
    T.StructField("row", T.LongType()),
    T.StructField("doc", T.LongType()),
    T.StructField("text_sha256", T.StringType()),
    T.StructField("leads", T.BooleanType()),
    T.StructField("run_keep", T.LongType()),
    T.StructField("run_size", T.LongType()),
    T.StructField("edge", T.IntegerType()),
    T.StructField("edge_text", T.StringType()),
]


def _runs(batches: Iterator[pa.RecordBatch], schema: pa.Schema, firsts_only: bool) -> Iterator[pa.RecordBatch]:
    """Mark the runs of equal texts in one sorted partition.

    A run's ids wait until it ends; its text is held once. Rows of the partition's first
    and last run are marked in `edge`, and its first and last row carry their text. With
    firsts_only, rows that surely do not lead a group stay behind.
    """
    payload = schema.names[len(OWN) :]
    part, row, run, text, size = None, 0, -1, None, 0
    waiting: list[tuple] = []
    out: list[tuple] = []

    def end_run(last: bool) -> None:
        edge = FIRST * (run == 0) + LAST * last
        digest, keep = sha256(text.encode()).hexdigest(), waiting[0][1]
        rows = waiting
        if firsts_only:
            rows = [waiting[0], waiting[-1]] if last and len(waiting) > 1 else waiting[:1]
        for at, doc, extra in rows:
            on_edge = at == 0 or last and at == row - 1
            out.append((part, at, doc, digest, at == waiting[0][0], keep, size, edge, text if on_edge else None, *extra))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        parts, docs, norms = (batch.column(c).to_pylist() for c in ("_part", "_doc", "_norm"))
        extras = list(zip(*[batch.column(c).to_pylist() for c in payload])) if payload else [()] * len(norms)
        for k, norm in enumerate(norms):
            part = parts[k]
            if norm != text:
                if waiting:
                    end_run(last=False)
                run, text, waiting, size = run + 1, norm, [], 0
            size += 1
            if firsts_only and len(waiting) > 1:
                waiting.pop()
            waiting.append((row, docs[k], extras[k]))
            row += 1
        if out:
            yield batch_of(out)
            out = []
    if waiting:
        end_run(last=True)
        yield batch_of(out)


def _groups_across(marked: DataFrame) -> DataFrame:
    """For the first and last run of each partition: where its group starts and how large it is.

    One row for each partition, so small. Only the comparison of boundary texts reads
    texts, and it is a join.
    """
    on_edge = marked.where("edge > 0")
    first, last = F.col("edge").bitwiseAND(FIRST) > 0, F.col("edge").bitwiseAND(LAST) > 0
    parts = on_edge.groupBy("part").agg(
        F.max(F.when(first, F.col("run_size"))).alias("first_size"),
        F.max(F.when(last, F.col("run_size"))).alias("last_size"),
        F.min_by(F.when(first, F.struct("run_keep")), F.when(first, F.col("row"))).alias("first_keep"),
        F.min_by(F.when(last, F.struct("run_keep")), F.when(last, F.col("row"))).alias("last_keep"),
        F.max(first & last).alias("single"),
    )
    texts = on_edge.where("edge_text is not null").groupBy("part").agg(
        F.min_by("edge_text", "row").alias("first_text"), F.max_by("edge_text", "row").alias("last_text")
    )
    by_part = Window.orderBy("part")  # one row per partition
    order = parts.select("part", F.lag("part").over(by_part).alias("before"))
    ends = texts.select(F.col("part").alias("before"), "last_text")
    starts = order.join(texts.select("part", "first_text"), "part")
    goes_on = starts.join(ends, "before").select("part", (F.col("first_text") == F.col("last_text")).alias("goes_on"))
    parts = parts.join(goes_on, "part", "left").withColumn("goes_on", F.coalesce("goes_on", F.lit(False)))

    # Number the groups of the runs at the edges in order.
    up_to = by_part.rowsBetween(Window.unboundedPreceding, 0)
    opens, splits = (~F.col("goes_on")).cast("long"), (~F.col("single")).cast("long")
    parts = parts.withColumn("last_group", F.sum(opens + splits).over(up_to)).withColumn("first_group", F.col("last_group") - splits)
    run = lambda edge, side: F.struct(
        F.lit(edge).alias("edge"),
        F.col(f"{side}_group").alias("group"),
        F.col(f"{side}_size").alias("size"),
        F.col(f"{side}_keep.run_keep").alias("keep"),
    )
    runs = F.when(F.col("single"), F.array(run(FIRST | LAST, "first"))).otherwise(F.array(run(FIRST, "first"), run(LAST, "last")))
    runs = parts.select("part", F.explode(runs).alias("r")).select("part", "r.*")
    groups = runs.groupBy("group").agg(
        F.sum("size").alias("group_size"),
        F.min("part").alias("start"),
        F.min_by(F.struct("keep"), "part").alias("keep"),
    )
    return runs.select("part", "edge", "group").join(groups, "group").select(
        "part", "edge", "group_size", "start", F.col("keep.keep").alias("group_keep")
    )


def _sorted_runs(df: DataFrame, id_col: str, text_col: str, payload: list[str], firsts_only: bool) -> DataFrame:
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ")
    rows = df.select(F.col(id_col).cast("long").alias("_doc"), norm.alias("_norm"), *[F.col(f"`{c}`") for c in payload])
    rows = rows.withColumn("_lead", F.substring("_norm", 1, LEAD)).withColumn("_hash", F.xxhash64("_norm"))
    order = ["_lead", "_hash", F.col("_doc").asc_nulls_last()]
    rows = rows.repartitionByRange(*order).sortWithinPartitions("_lead", "_hash", "_norm", F.col("_doc").asc_nulls_last())
    rows = rows.select(F.spark_partition_id().alias("_part"), "_doc", "_norm", *[F.col(f"`{c}`") for c in payload])
    made = T.StructType(OWN + [T.StructField(f"in_{c}", df.schema[c].dataType) for c in payload])
    rows = rows.select("_part", "_doc", "_norm", *[F.col(f"`{c}`").alias(f"in_{c}") for c in payload])
    arrow = to_arrow_schema(made)
    marked = rows.mapInArrow(lambda batches: _runs(batches, arrow, firsts_only), made)
    with small_batches(df.sparkSession, BATCH_ROWS):
        marked = staged(marked, "runs")
    across = _groups_across(marked)
    return marked.drop("edge_text").join(across, ["part", "edge"], "left").withColumn(
        "kept", F.col("leads") & (F.coalesce("start", "part") == F.col("part"))
    )


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: the id, keep_id, group_size, kept and text_sha256.

    Texts are equal if they are identical after each run of white space (tab to carriage
    return, space) becomes one space; a null text counts as empty, and empty texts equal
    each other. Of equal texts the row with the smallest id is kept. Rows without an id
    come last; where no row of a group has one, keep_id is null and one row is kept. Of
    rows that share id and text, one is kept. An empty table gives an empty table. Other
    columns are not read.
    """
    rows = _sorted_runs(df, id_col, text_col, [], firsts_only=False)
    keep = F.when(F.col("start").isNull(), F.col("run_keep")).otherwise(F.col("group_keep"))
    return rows.select(
        F.col("doc").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", "run_size").alias("group_size"),
        "kept",
        "text_sha256",
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that `exact_duplicates` keeps, with all columns of df as they were."""
    rows = _sorted_runs(df, id_col, text_col, df.columns, firsts_only=True).where("kept")
    return rows.select(*[F.col(f"`in_{c}`").alias(c) for c in df.columns])
