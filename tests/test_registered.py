"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_module  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{name}'")
    return con


def normal(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else repr(value)


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["station_id", "n", "mae", "rmse"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, tables, name):
    df = QUERIES[name](spark, SF)
    cursor = tables.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert multiset(df.columns, df.collect()) == multiset(columns, cursor.fetchall())
