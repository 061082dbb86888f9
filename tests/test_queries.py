"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from sluicegate.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    result = duck.execute(f"SELECT {quoted} FROM ({ORACLE_SQL[name]})")
    assert len(result.description) == len(df.columns)
    assert got == sorted(map(repr, result.fetchall()))
    assert got


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert entry_module.queries().keys() >= QUERIES.keys()
    assert entry_module.oracle_sql().keys() <= entry_module.queries().keys()


def test_entry(spark):
    report = entry_module.entry(spark)
    assert report.count() == 13
