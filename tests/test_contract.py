"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
import check
from duelspark.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, tables, name):
    df = contract.queries()[name](spark, FOLDER)
    cur = tables.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert check.rows(df.columns, df.collect()) == check.rows(names, cur.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
