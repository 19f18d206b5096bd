"""Every registered query against its SQL on the smallest data."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TABLES, rows_of
from workload.registry import all_oracles, all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows_of(names, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 4
