"""The registered queries: beside their SQL, and their columns."""

import duckdb
import pytest

import __spark_entry__ as contract
from storytide.llm import queries
from tools.compare import TABLES, rows_of

DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.REGISTRY}
    assert set(queries.REGISTRY) | {"pipeline"} <= set(contract.queries())
    assert set(queries.ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIR}/{table}.parquet'")
    frame = queries.REGISTRY[name](spark, DIR)
    cursor = duck.execute(queries.ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, cursor.fetchall())


def test_folds_of_the_learnt_queries(spark):
    import zlib

    for name in ("op1_language_id", "op6_quality_classifier"):
        rows = queries.REGISTRY[name](spark, DIR).collect()
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows) and len(rows) == 200
