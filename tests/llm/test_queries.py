"""Queries that have SQL, against DuckDB."""

import duckdb
import pytest

from strataframe.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.sql(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    found, wanted = queries.queries()[name](spark, DATA).toPandas(), con.sql(queries.oracle_sql()[name]).df()
    columns = sorted(wanted)
    assert sorted(found) == columns
    rows = lambda frame: sorted(map(tuple, frame[columns].astype(object).where(frame[columns].notna(), None).to_numpy().tolist()), key=str)
    assert rows(found) == rows(wanted)
