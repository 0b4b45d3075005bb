from __future__ import annotations

import duckdb
import pytest

from .conftest import SF
from slotwise.llm.oracle import LLM_ORACLE
from slotwise.llm.queries import LLM_QUERIES


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = LLM_QUERIES[name](spark, SF)
    cursor = con.execute(LLM_ORACLE[name])
    assert df.columns == [d[0] for d in cursor.description]
    assert sorted(map(tuple, df.collect())) == sorted(cursor.fetchall())
