"""Every registered query beside its SQL, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as contract
from storytide.checks.oracle import oracle
from storytide.checks.queries import REGISTRY
from tools.compare import TABLES, rows_of

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    return connection


def test_every_query_has_a_statement():
    assert set(oracle()) == set(REGISTRY) <= set(contract.queries())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_its_sql(spark, duck, name):
    frame = REGISTRY[name](spark, DIR)
    got = rows_of(frame.columns, frame.collect())
    cursor = duck.execute(oracle()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert got == rows_of(names, cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 10
