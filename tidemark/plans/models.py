"""Model materialisation and build order.

A "view" model is a lazy DataFrame function, inlined into whatever reads it.
A "table" model is written once to a new folder and published by a numbered
pointer (create-if-absent), then read back, so every downstream model reads
files instead of recomputing its inputs (the lineage is cut at each table).
Build order follows the declared references (a topological order of a graph
of a dozen names, computed on the driver).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.timeutil import calendar
from ..sources.lake import FileSystem
from . import marts
from . import warehouse as wh

# name -> (materialisation, references, builder)
MODELS: dict[str, tuple[str, tuple[str, ...], Callable]] = {
    "stg_orders": ("view", ("order_versions",), lambda f: wh.stg_orders(f["order_versions"])),
    "stg_payments": ("view", ("payment_versions",), lambda f: wh.stg_payments(f["payment_versions"])),
    "dim_customer": ("table", ("customer_history",), lambda f: wh.dim_customer(f["customer_history"])),
    "dim_product": ("table", ("products",), lambda f: wh.dim_product(f["products"])),
    "fct_orders": ("table", ("stg_orders", "dim_customer"),
                   lambda f: wh.fct_orders(f["stg_orders"], f["dim_customer"])),
    "fct_order_items": ("table", ("order_items", "fct_orders", "dim_product"),
                        lambda f: wh.fct_order_items(f["order_items"], f["fct_orders"], f["dim_product"])),
    "fct_payments": ("table", ("stg_payments",), lambda f: wh.fct_payments(f["stg_payments"])),
    "fct_refunds": ("table", ("refunds",), lambda f: wh.fct_refunds(f["refunds"])),
    "daily_finance": ("table", ("fct_payments", "fct_refunds"),
                      lambda f: marts.daily_finance(f["fct_payments"], f["fct_refunds"])),
    "daily_clickstream": ("table", ("clicks",), lambda f: marts.daily_clickstream(f["clicks"])),
    "orders_by_city_membership": ("table", ("fct_orders", "dim_customer"),
                                  lambda f: marts.orders_by_city_membership(f["fct_orders"], f["dim_customer"])),
}
SOURCES = ("order_versions", "payment_versions", "customer_history", "products", "order_items",
           "refunds", "clicks")


def build_order(models=MODELS) -> list[str]:
    done: list[str] = []
    seen: set[str] = set(SOURCES)

    def visit(name, path=()):
        if name in seen:
            return
        if name in path:
            raise ValueError(f"model cycle at {name}")
        for ref in models[name][1]:
            visit(ref, path + (name,))
        seen.add(name)
        done.append(name)
    for n in models:
        visit(n)
    return done


def build(spark: SparkSession, sources: dict[str, DataFrame], root: str,
          dim_date: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """Build every model; table models are written under ``root/<model>/``."""
    fs = FileSystem(spark, root)
    frames = dict(sources)
    built = {}
    for name in build_order():
        kind, _, builder = MODELS[name]
        df = builder(frames)
        if kind == "table":
            df = _materialise(spark, fs, root, name, df)
        frames[name] = built[name] = df
    cal = calendar(spark, *dim_date) if dim_date else calendar(spark)
    built["dim_date"] = _materialise(spark, fs, root, "dim_date", cal)
    return built


def _materialise(spark, fs, root, name, df) -> DataFrame:
    folder = uuid.uuid4().hex
    # hashes in hex are half as long with a coder of entropy
    df.write.option("compression", "zstd").parquet(f"{root}/{name}/{folder}")
    names = [n for n in fs.list_names(f"{root}/{name}/_current") if n.endswith(".json")]
    n = max((int(x[:-5]) for x in names), default=0) + 1
    while not fs.create_new(f"{root}/{name}/_current/{n:020d}.json", json.dumps({"folder": folder})):
        n += 1
    return spark.read.schema(df.schema).parquet(f"{root}/{name}/{folder}")


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The published version of a table model."""
    fs = FileSystem(spark, root)
    names = [n for n in fs.list_names(f"{root}/{name}/_current") if n.endswith(".json")]
    folder = json.loads(fs.read_text(f"{root}/{name}/_current/{max(names)}"))["folder"]
    return spark.read.parquet(f"{root}/{name}/{folder}")
