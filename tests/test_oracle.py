"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of
from workload import queries as registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert {q.__name__ for q in registered.ALL} <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", [q.__name__ for q in registered.ALL])
def test_query_equals_sql(spark, db, name):
    ours = queries()[name](spark, SF).toArrow()
    theirs = db.sql(oracle_sql()[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    assert rows_of(ours) == rows_of(theirs)
