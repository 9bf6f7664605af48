"""Registered queries: all have SQL, and a few run against DuckDB (``check.py`` runs all)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, bag
from workload.queries import SPARK, SQL

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(SPARK) == set(SQL)
    assert set(SPARK) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")
@pytest.mark.parametrize("name", ["receivables", "stale_deals", "sources_romi", "e_payments", "issues_stage_history"])
def test_rows_equal_duckdb(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    df = entry.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, df.collect()) == bag(columns, result.fetchall())
