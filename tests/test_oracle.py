"""Every registered query against its SQL counterpart."""

import duckdb
import pytest

import __spark_entry__ as contract
from pulselake.plans import queries, stream_queries
from pulselake.plans.oracle import ORACLE as SQL

DATA = "/root/testdata/sf0.001"
QUERIES = {**queries.QUERIES, **stream_queries.QUERIES}
TYPES = {
    "string": "VARCHAR", "long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= contract.queries().items()
    assert SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    result = con.execute(SQL[name])
    expected_types = {d[0]: str(d[1]) for d in result.description}
    order = sorted(expected_types)
    assert sorted(df.columns) == order
    assert {f.name: TYPES.get(f.dataType.typeName()) for f in df.schema} == expected_types
    position = {d[0]: i for i, d in enumerate(result.description)}
    expected = sorted([tuple(r[position[c]] for c in order) for r in result.fetchall()], key=repr)
    assert sorted([tuple(r[c] for c in order) for r in df.collect()], key=repr) == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0
