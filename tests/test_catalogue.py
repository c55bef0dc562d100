"""Every registered query of the engine against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tickloom.plans import catalogue

DATA = os.environ.get("TICKLOOM_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "events orders nation".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return repr(float(v) + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    rows = df.collect()
    spark.catalog.clearCache()
    assert rows
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == sorted(df.columns)
    cols = sorted(df.columns)
    where = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(plain(r[i]) for i in where) for r in rel.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in rows) == want
