"""Every registered query next to its SQL, at the smallest scale."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracles import ORACLES, TABLES
from catalog.queries import QUERIES
from check import by_name

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    result = con.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert by_name(df.collect(), df.columns) == by_name(result.fetchall(), columns)


def test_entry(spark):
    assert entry(spark).count() == 5
