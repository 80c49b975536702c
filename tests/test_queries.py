"""Every query against its SQL in DuckDB over the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from strataframe import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def rows(frame):
    plain = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else str(v)
    return sorted(([plain(v) for v in r] for r in frame[sorted(frame)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = catalog.queries()[name](spark, DATA).toPandas()
    wanted = duck.sql(catalog.oracle_sql()[name]).df()
    assert sorted(found) == sorted(wanted)
    assert rows(found) == rows(wanted)
    assert len(found)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalog.queries()[name](spark, DATA).count()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 640
