"""Queries of this package against their SQL on the smallest tables."""

import duckdb
import pytest

import check
from duelspark.llm import sharding
from duelspark.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for table in check.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cur = con.execute(ORACLE[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert check.rows(df.columns, df.collect()) == check.rows(names, cur.fetchall())


def test_slots_follow_the_sql_in_many_blocks(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    df = sharding.shard_table(docs, [1.0] * 24, rows_per_block=15)
    got = sorted((r.doc_id, r.shard, r.slot, r.grown_shard) for r in df.collect())
    assert got == sorted(con.sql(f"SELECT doc_id, shard, slot, grown_shard FROM ({ORACLE['op2_rendezvous_shards']})").fetchall())
