"""Shuffles of keys: surrogate keys are packed, lines are numbered once for items and refunds."""

from datetime import datetime

from tidemark.operators.checks import unique_violations
from tidemark.sources import derived


def test_unique_keys_are_grouped_packed_and_given_back(spark):
    a, b = "0123456789abcdef" * 2, "0123456789ABCDEF" * 2
    rows = [(a, 1), (a, 1), (b, 1), (a, 2), ("x", 1), ("x", 1), (None, 1), (None, 1), ("", 3), ("", 3)]
    found = unique_violations(spark.createDataFrame(rows, "k string, n bigint"), ["k", "n"])
    assert sorted(tuple(r) for r in found.collect()) == [("", 3, 2), (a, 1, 2), ("x", 1, 2)]
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex" in text[text.index("Aggregate"):]


def test_items_and_refunds_take_lines_numbered_before(spark, tmp_path):
    day = datetime(1997, 1, 1)
    rows = [(k, p, 1, n, 1.0, float(p), 0.0, 0.0, flag, "O", day) for k, p, n, flag in
            [(1, 5, 1, "R"), (1, 4, 1, "N"), (1, 4, 1, "R"), (2, 3, 2, "R"), (None, 1, 1, "R"), (None, 1, 1, "R")]]
    spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    derived.numbered_lines(spark, str(tmp_path)).write.parquet(f"{tmp_path}/numbered")
    lines = spark.read.parquet(f"{tmp_path}/numbered")
    for feed in (derived.order_items, derived.refunds):
        plain, given = feed(spark, str(tmp_path)), feed(spark, str(tmp_path), lines)
        assert sorted(map(str, plain.collect())) == sorted(map(str, given.collect()))
        assert "Window" not in given._jdf.queryExecution().optimizedPlan().toString()
