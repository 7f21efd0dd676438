"""Deleting rows together with what depends on them."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legalops.model import CASCADE, RESTRICT, SET_NULL, TABLES
from legalops.session import shared_folder
from legalops.sources import versions
from legalops.sources.tables import Tables, stage


class Purge(NamedTuple):
    tables: dict[str, DataFrame]
    effects: DataFrame


def _flagged(rows: DataFrame, gone: DataFrame, columns: tuple[str, ...], keys: tuple[str, ...], flag: str) -> DataFrame:
    """The rows with a flag on those whose `columns` are among the distinct keys of `gone`."""
    hit = gone.select(*[F.col(k).alias(c) for k, c in zip(keys, columns)]).distinct()
    return rows.join(hit.withColumn(flag, F.lit(True)), list(columns), "left")


def _parents_first() -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for fk in TABLES[name].foreign_keys:
                visit(fk.parent)
            order.append(name)

    for name in TABLES:
        visit(name)
    return order


def _referred_columns(name: str, t: Tables) -> list[str]:
    """The columns of a table that other given tables refer to."""
    found = [c for other in t for fk in TABLES[other].foreign_keys if fk.parent == name for c in fk.parent_columns]
    return list(dict.fromkeys(found))


def cascade_purge(t: Tables, root: str, doomed: DataFrame) -> Purge:
    """The tables after deleting `doomed` rows of `root` and all that hangs on them.

    `doomed` holds key values of `root`. Rows under a cascading reference go too,
    set-null references to deleted rows become NULL, and rows left under a plain
    reference block the delete. `effects` counts them (table_name, action, rows),
    action being removed, emptied or blocking. Write the tables only if nothing blocks;
    `write_purge` looks.

    Tables are walked from parents to children. The keys that go from a table which others
    refer to are written when it is reached, and its children are marked from the written
    keys, so the plan of a table holds no more than its own references, however deep it
    lies. Removed rows and rows after it add up to the rows before.
    """
    spark = doomed.sparkSession
    key = TABLES[root].primary_key
    gone: dict[str, DataFrame] = {root: stage(doomed.select(*key).distinct(), shared_folder(spark, f"doomed-{root}"))}
    after: dict[str, DataFrame] = {}
    effects: list[DataFrame] = []

    for name in _parents_first():
        if name not in t:
            continue
        reached = [fk for fk in TABLES[name].foreign_keys if fk.parent in gone]
        if not reached and name != root:
            after[name] = t[name]
            continue
        columns = t[name].columns
        rows, flags = t[name], {CASCADE: [], SET_NULL: [], RESTRICT: []}
        for i, fk in enumerate(reached):
            rows = _flagged(rows, gone[fk.parent], fk.columns, fk.parent_columns, f"_hit{i}")
            flags[fk.on_delete].append((f"_hit{i}", fk))
        if name == root:
            rows = _flagged(rows, gone[root], key, key, "_doomed")
            flags[CASCADE].append(("_doomed", None))

        hit = lambda kind: F.coalesce(*[F.col(flag) for flag, _ in flags[kind]], F.lit(False))
        # One pass counts all that happens to the table.
        counts = []
        removed = F.lit(False)
        if flags[CASCADE]:
            removed = hit(CASCADE)
            counts.append(("removed", removed))
        counts += [("emptied", ~removed & F.coalesce(flag, F.lit(False))) for flag, _ in flags[SET_NULL]]
        if flags[RESTRICT]:
            # A row that two references hold back blocks once.
            counts.append(("blocking", ~removed & hit(RESTRICT)))
        found = rows.agg(*[F.count_if(happens).alias(f"_{i}") for i, (_, happens) in enumerate(counts)])
        unfolded = F.inline(F.array(*[F.struct(F.lit(action).alias("action"), F.col(f"_{i}").alias("rows")) for i, (action, _) in enumerate(counts)]))
        effects.append(found.select(F.lit(name).alias("table_name"), unfolded))

        if flags[CASCADE]:
            referred = _referred_columns(name, t)
            if referred:
                keys = rows.where(removed).select(*dict.fromkeys([*referred, *(key if name == root else ())])).distinct()
                gone[name] = stage(keys, shared_folder(spark, f"gone-{name}"))
            rows = rows.where(~removed)
        emptied = {c: flag for flag, fk in flags[SET_NULL] for c in fk.columns}
        after[name] = rows.select(
            *[F.when(F.col(emptied[c]).isNull(), F.col(c)).alias(c) if c in emptied else F.col(c) for c in columns]
        )
    counted = reduce(DataFrame.unionByName, effects).groupBy("table_name", "action")
    return Purge(after, counted.agg(F.sum("rows").alias("rows")))


def write_purge(spark: SparkSession, store: str, root: str, doomed: DataFrame) -> DataFrame:
    """Purge the current version of a store (`sources.versions`) and publish all changed tables at once.

    Nothing is published where a reference blocks: that raises a ValueError that names the
    tables. Readers see the tables before the purge or all of those after it. Gives the
    effects.
    """
    since = versions.current_version(spark, store)
    purge = cascade_purge(versions.read_current(spark, store, since), root, doomed)
    effects = stage(purge.effects, shared_folder(spark, "effects"))
    found = effects.where("rows > 0").collect()  # at most three rows a table
    blocked = sorted(r["table_name"] for r in found if r["action"] == "blocking")
    if blocked:
        raise ValueError(f"rows of {', '.join(blocked)} refer to {root} rows to be deleted")
    changed = {r["table_name"] for r in found}
    if changed:
        versions.replace_tables({name: purge.tables[name] for name in changed}, store, since)
    return effects
