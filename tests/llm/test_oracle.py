"""Queries with SQL give DuckDB's rows."""

import duckdb
import pytest

from martloom.llm.oracle import ORACLES
from martloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    with duckdb.connect() as db:
        for table in ("documents", "benchmark", "conversations"):
            db.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
        want = db.sql(ORACLES[name])
        columns, rows = want.columns, want.fetchall()
    mine = QUERIES[name](spark, SF)
    assert sorted(mine.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in mine.select(*columns).collect()))) == sorted(map(repr, rows))
