"""Queries whose SQL leaves sums or ties to the order of rows: they answer as SQL does that reads the tables from their start."""

import datetime
import random

import pytest

import __spark_entry__ as entry
from test_catalog import rows

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Few strikes, deltas of which many means are evenly far from 0.25, and order numbers that repeat."""
    rng, root = random.Random(7), tmp_path_factory.mktemp("row-order")
    start = datetime.datetime(1995, 1, 3)
    lines = []
    for _ in range(20_000):
        day = start + datetime.timedelta(days=rng.randrange(28 * 24))
        lines.append((rng.randrange(40), rng.randrange(6), 100 * rng.randrange(9) + rng.choice((10, 15, 20, 21, 29, 30, 35, 40)), rng.randrange(1, 8), float(rng.randrange(1, 50)), rng.randrange(90_000, 110_000) / 100, rng.randrange(11) / 100, rng.randrange(9) / 100, rng.choice("RAN"), rng.choice("OF"), day))
    spark.createDataFrame(lines, LINES).coalesce(1).write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame([(i, 900.0 + 35 * i) for i in range(6)], "p_partkey long, p_retailprice double").coalesce(1).write.parquet(f"{root}/part.parquet")
    return str(root)


@pytest.mark.parametrize("name", ["option_atoms", "option_panel", "option_day_rows"])
def test_query_agrees_with_its_sql_in_table_order(spark, tables, name):
    import duckdb

    con = duckdb.connect(config={"threads": 1})
    for t in ("lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    df = entry.queries()[name](spark, tables)
    found = [tuple(r) for r in df.collect()]
    want = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert len(found) > 30 and rows(found, df.columns, df.columns) == rows(want.fetchall(), df.columns, columns)
