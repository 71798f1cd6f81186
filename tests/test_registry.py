"""Registered queries against their SQL on the smallest scale factor."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from registry.oracles import ORACLES
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = sql.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    rows = [tuple(r) for r in df.collect()]
    assert normal(rows, df.columns) == normal(cursor.fetchall(), columns)
    if name not in ("check_fk", "check_unique"):
        assert rows


def test_smoke_entry(spark):
    assert entry.entry(spark).count() == 100
