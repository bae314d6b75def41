"""Registered corpus queries: each against its SQL where there is one, on the smallest tables."""

import os

import pytest

from tools.check import TABLES, rows
from waybill.llm.queries import QUERIES, SQL

FOLDER = os.environ.get("CORPUS_SF_DIR", "/root/testdata/sf0.001")

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(SQL))
def test_query_agrees_with_its_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())


def test_one_query_of_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
