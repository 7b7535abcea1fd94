"""Queries with a SQL twin equal it."""

from __future__ import annotations

import duckdb
import pytest

from check_oracle import TABLES, _rows
from tablewarden.llm.oracle import ORACLE_SQL
from tablewarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twin(spark, name):
    oracle = duckdb.connect()
    for table in TABLES:
        oracle.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    cursor = oracle.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(columns) == sorted(df.columns) and got and got == _rows(columns, cursor.fetchall())
