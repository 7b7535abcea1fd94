"""Every registered query equals its SQL twin on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import TABLES, _rows
from tablewarden.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = oracle.execute(oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == _rows(columns, cursor.fetchall())
    assert got


def test_entry(spark):
    assert entry(spark).count() > 0
