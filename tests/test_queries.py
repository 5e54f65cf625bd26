"""Every registered query with SQL, against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from docweave import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_equals_sql(spark, duck, name):
    got, want = Q.QUERIES[name](spark, SF), duck.sql(Q.SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    left = sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key)
    right = sorted(want.select(*[f'"{c}"' for c in cols]).fetchall(), key=key)
    assert left == right


def test_every_query_has_sql():
    assert Q.QUERIES.keys() == Q.SQL.keys()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 185
    assert set(Q.QUERIES) <= set(e.queries()) and set(Q.SQL) <= set(e.oracle_sql())
