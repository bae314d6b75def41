"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__
from entries import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    from tools.check import TABLES

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query_agrees_with_its_sql(spark, con, name):
    from tools.check import compare

    assert compare(spark, con, name, FOLDER).startswith("ok")


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(queries())


def test_flagship(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["bank_account", "month", "inflows", "outflows", "net_flow"] and df.count() > 0
