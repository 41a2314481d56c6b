"""Every registered query against DuckDB on the smallest data set."""

import math
import os

import duckdb
import pytest

from martloom.workload.oracle import oracle_queries
from martloom.workload.queries import QUERIES

DATA = os.environ.get("MARTLOOM_TESTDATA", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 6)
        return v

    return [columns[i] for i in order], sorted(
        (tuple(value(r[i]) for i in order) for r in rows), key=repr
    )


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    result = duck.execute(oracle_queries()[name])
    expected = canonical([c[0] for c in result.description], result.fetchall())
    assert canonical(df.columns, df.collect()) == expected
