"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from oracle_check import compare  # noqa: E402
from tidemark.sources.tables import DRIVER_TABLES  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, SF, key, E.queries()[key], E.oracle_sql().get(key))
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_date", "currency", "order_count", "order_value"]
    assert df.count() > 0
