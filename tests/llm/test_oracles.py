"""Queries that SQL can state, against DuckDB on the smallest table."""

from collections import Counter

import duckdb
import pytest

from tidemark.llm import catalog

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = catalog.QUERIES[name](spark, SF)
    expected = con.execute(catalog.ORACLE_SQL[name]).fetchall()
    assert found.columns == [c[0] for c in con.description]
    assert Counter(map(tuple, found.collect())) == Counter(expected)
