from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from legalops.model import TABLES  # noqa: E402
from legalops.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tables(spark):
    """Make tables from rows of the named columns; other columns are NULL, other tables empty."""

    def make(**given):
        made = {}
        for name, table in TABLES.items():
            columns, rows = given.get(name, ("", []))
            names = columns.split()
            full = [tuple(dict(zip(names, row)).get(f.name) for f in table.schema.fields) for row in rows]
            relaxed = type(table.schema)(
                [type(f)(f.name, f.dataType, True) for f in table.schema.fields]
            )
            made[name] = spark.createDataFrame(full, relaxed)
        return made

    return make


def rows(df, *columns):
    """The rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
