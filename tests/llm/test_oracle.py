"""Queries with SQL over the same tables."""

import duckdb
import pytest
from helpers import DATA

from pulselake.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    df = QUERIES[name](spark, str(DATA))
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(result.fetchall())
