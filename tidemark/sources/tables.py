"""Readers for the given driver tables.

Every reader is a plain ``spark.read.parquet``; column pruning and filter
pushdown reach the scan because callers only ``select``/``where`` on top.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

