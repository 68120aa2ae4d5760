"""Each query against its SQL on the smallest driver tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    v = float(v)
    return None if math.isnan(v) else round(v, 9)


def rows(found, columns, names):
    at = [names.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in at) for r in found), key=repr)


def own_queries():
    return [n for n in entry.queries() if n not in llm_names()]


def llm_names():
    if entry.llm is None:
        return set()
    from tidemark.llm.queries import QUERIES

    return {*QUERIES, "pipeline"}


@pytest.mark.parametrize("name", own_queries())
def test_query_agrees_with_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert found
        return
    want = duck.sql(sql)
    assert sorted(want.columns) == sorted(df.columns)
    assert rows(found, df.columns, df.columns) == rows(want.fetchall(), df.columns, want.columns)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
