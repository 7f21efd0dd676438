"""The model's keys, references and rules, checked as jobs.

Every audit returns one row per rule: table_name, rule, failing_rows and the
smallest key among the failing rows. A rule that holds has 0 failing rows.

Each audit scans a table once for all its rules. Keys meet in one shuffle as typed values,
with copies of a key counted before it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.model import TABLES, Table
from legalops.sources.tables import Tables

RuleName = tuple[str, str]


def key_text(columns: Sequence[str]) -> str:
    """SQL for a key as the findings show it."""
    parts = ", ".join(f"coalesce(CAST({c} AS STRING), '')" for c in columns)
    return f"concat_ws('|', {parts})"


# A key of any table as values of fixed columns: whole numbers and days, then texts.
SLOTS = ("n1", "n2", "n3", "t1", "t2")


def _slots(table: Table, columns: Sequence[str]) -> dict[str, tuple[str, str]]:
    """For each column the slot that holds it and the column's type."""
    numbers, texts, found = iter(SLOTS[:3]), iter(SLOTS[3:]), {}
    for c in columns:
        kind = table.schema[c].dataType.simpleString()
        found[c] = (next(texts if kind == "string" else numbers), kind)
    return found


def typed_key(table: Table, columns: Sequence[str]) -> str:
    """SQL for the slots of a key, those it does not fill being NULL."""
    held = {slot: f"unix_date({c})" if kind == "date" else c for c, (slot, kind) in _slots(table, columns).items()}
    return ", ".join(f"CAST({held.get(s, 'NULL')} AS {'BIGINT' if s[0] == 'n' else 'STRING'}) AS {s}" for s in SLOTS)


def key_text_of_slots(table: Table, columns: Sequence[str]) -> str:
    """SQL for a key as the findings show it, from its slots."""
    held = _slots(table, columns).values()
    parts = (f"coalesce(CAST({f'date_from_unix_date(CAST({s} AS INT))' if kind == 'date' else s} AS STRING), '')" for s, kind in held)
    return f"concat_ws('|', {', '.join(parts)})"


def _all_present(columns: Sequence[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def _text_by_rule(texts: Sequence[str]) -> Column:
    return F.expr("CASE i " + " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(texts)) + " END")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _unfold(df: DataFrame, structs: Iterable[str]) -> DataFrame:
    """A row for each of the SQL structs, for every row of `df`."""
    return df.selectExpr(f"inline(array({', '.join(structs)}))")


def _findings(failing: DataFrame, rules: Sequence[RuleName]) -> DataFrame:
    """Totals by rule of `failing` (rule number, key, rows), 0 for rules without any."""
    names = _unfold(
        failing.sparkSession.range(1),
        (f"struct({i} AS i, '{table}' AS table_name, '{rule}' AS rule)" for i, (table, rule) in enumerate(rules)),
    )
    totals = failing.groupBy("i").agg(F.sum("rows").alias("failing_rows"), F.min("key").alias("sample_key"))
    return names.join(totals, "i", "left").select(
        "table_name", "rule", F.coalesce("failing_rows", F.lit(0)).alias("failing_rows"), "sample_key"
    )


def row_rules(table: Table, kinds: Sequence[str]) -> list[tuple[str, str]]:
    """Rules (name, SQL that is TRUE for a failing row)."""
    rules = []
    if "nulls" in kinds:
        rules += [(f"{c} is required", f"{c} IS NULL") for c in table.required]
    if "checks" in kinds:
        # Only a rule that is FALSE fails; one that is NULL passes.
        rules += [(name, f"NOT ({sql})") for name, sql in table.checks.items()]
        rules += [
            (f"{c} in domain", f"{c} NOT IN ({', '.join(f'{v!r}' for v in values)})")
            for c, values in table.domains.items()
        ]
    if "identifiers" in kinds:
        rules += [(name, f"NOT ({sql})") for name, sql in table.formats.items()]
    return rules


def audit_rows(t: Tables, kinds: Sequence[str] = ("nulls", "checks", "identifiers")) -> DataFrame:
    """Rules that look at one row: required columns, checks and domains, formats.

    Rows that break no rule are filtered out in the scan.
    """
    rules: list[RuleName] = []
    parts = []
    for name, table in TABLES.items():
        broken_if = row_rules(table, kinds)
        if not broken_if or name not in t:
            continue
        broken = ", ".join(f"CASE WHEN {sql} THEN {len(rules) + i} END" for i, (_, sql) in enumerate(broken_if))
        parts.append(
            t[name]
            .where(" OR ".join(f"({sql})" for _, sql in broken_if))
            .selectExpr(
                f"explode(array_compact(array({broken}))) AS i", f"{key_text(table.primary_key)} AS key", "1L AS rows"
            )
        )
        rules += [(name, rule) for rule, _ in broken_if]
    return _findings(_union(parts), rules)


def audit_nulls(t: Tables) -> DataFrame:
    return audit_rows(t, ["nulls"])


def audit_checks(t: Tables) -> DataFrame:
    return audit_rows(t, ["checks"])


def audit_identifiers(t: Tables) -> DataFrame:
    return audit_rows(t, ["identifiers"])


def audit_keys(t: Tables) -> DataFrame:
    """Keys that occur more than once; a NULL in a unique column does not count.

    failing_rows counts all rows of a repeated key.
    """
    rules: list[RuleName] = []
    parts, texts = [], []
    for name, table in TABLES.items():
        if name not in t:
            continue
        keys = [(f"primary key ({', '.join(table.primary_key)})", "TRUE", table.primary_key)]
        keys += [(f"unique ({c})", f"{c} IS NOT NULL", (c,)) for c in table.unique]
        structs = (
            f"CASE WHEN {counts} THEN struct({len(rules) + i} AS i, {typed_key(table, columns)}) END"
            for i, (_, counts, columns) in enumerate(keys)
        )
        parts.append(t[name].selectExpr(f"inline(array_compact(array({', '.join(structs)})))"))
        rules += [(name, rule) for rule, _, _ in keys]
        texts += [key_text_of_slots(table, columns) for _, _, columns in keys]
    counted = _union(parts).groupBy("i", *SLOTS).agg(F.count("*").alias("rows"))
    repeated = counted.where(F.col("rows") > 1).select("i", _text_by_rule(texts).alias("key"), "rows")
    return _findings(repeated, rules)


def audit_orphans(t: Tables) -> DataFrame:
    """References that point to no row; a NULL in any part passes.

    A parent's keys and the values of all that refers to it are grouped together, as typed
    values, and a parent is read once however many references it has. A value that no row
    of the parent shares is an orphan; one that many rows hold is one row by then. (A Bloom
    filter of the parent's keys would not save the shuffle: an orphan may pass it, so what
    passes has to be looked up, and that is nearly all.)
    """
    rules: list[RuleName] = []
    texts: list[str] = []
    # For each referred key its number; for each of its references the rule's number.
    keys: dict[tuple, int] = {}
    referring: dict[int, list[int]] = {}
    structs: dict[str, list[str]] = {name: [] for name in TABLES}
    for name, table in TABLES.items():
        for fk in table.foreign_keys:
            if name not in t or fk.parent not in t:
                continue
            if (fk.parent, fk.parent_columns) not in keys:
                number = keys[fk.parent, fk.parent_columns] = len(keys)
                held = typed_key(TABLES[fk.parent], fk.parent_columns)
                structs[fk.parent].append(
                    f"CASE WHEN {_all_present(fk.parent_columns)} THEN struct({number} AS key, -1 AS place, {held}) END"
                )
            number = keys[fk.parent, fk.parent_columns]
            own = referring.setdefault(number, [])
            value = f"struct({number} AS key, {len(own)} AS place, {typed_key(table, fk.columns)})"
            structs[name].append(f"CASE WHEN {_all_present(fk.columns)} THEN {value} END")
            own.append(len(rules))
            rules.append((name, f"({', '.join(fk.columns)}) references {fk.parent}"))
            texts.append(key_text_of_slots(table, fk.columns))
    if not rules:
        return audit_rows(t).where("false")

    parts = [t[name].selectExpr(f"inline(array_compact(array({', '.join(own)})))") for name, own in structs.items() if own]
    most = max(len(own) for own in referring.values())
    counts = [F.count_if(F.col("place") == k).alias(f"_{k}") for k in range(most)]
    grouped = _union(parts).groupBy("key", *SLOTS).agg(F.count_if(F.col("place") < 0).alias("parents"), *counts)
    numbered = "CASE key " + " ".join(f"WHEN {n} THEN array({', '.join(map(str, own))})" for n, own in referring.items()) + " END"
    by_rule = F.arrays_zip(F.expr(numbered).alias("i"), F.array(*[F.col(f"_{k}") for k in range(most)]).alias("rows"))
    orphans = grouped.where("parents = 0").select(*SLOTS, F.inline(by_rule)).where("i IS NOT NULL AND rows > 0")
    return _findings(orphans.select("i", _text_by_rule(texts).alias("key"), "rows"), rules)


def audit(t: Tables) -> DataFrame:
    """Every rule of the model."""
    return _union([audit_keys(t), audit_orphans(t), audit_rows(t)])
