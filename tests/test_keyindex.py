"""The index of landed keys: what it finds, and what its plans read and shuffle."""

import glob
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources.keyindex import PROBE_KEYS, KeyIndex
from tidemark.sources.lake import Lake

SCHEMA = schemas.RAW_PAYMENT_VERSIONS


def rows(spark, low, high, tag="h"):
    ids = spark.range(low, high)
    return ids.select(F.concat(F.lit("p"), "id").alias("payment_id"), (F.col("id") % 3 + 1).alias("version"),
                      F.lit("o").alias("order_id"), F.lit("{}").alias("payload"),
                      F.concat(F.lit(tag), "id").alias("payload_hash"), F.current_timestamp().alias("ingested_at"),
                      F.lit("page").alias("page_id")).select(*SCHEMA.fieldNames())


def index_of(lake):
    return KeyIndex(lake, "raw_payment_versions", SCHEMA, ("payment_id", "version"), buckets=8)


def land(lake, frame, indexed=True):
    index = index_of(lake)
    staged = {"raw_payment_versions": [lake.stage("raw_payment_versions", frame)]}
    if indexed:
        staged[index.entry] = [index.stage(frame)]
    lake.commit(staged)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def found(index, batch):
    return sorted((r["payment_id"], r["version"], r["payload_hash"]) for r in index.landed(batch).collect())


@pytest.mark.parametrize("size", [5, PROBE_KEYS * 4])
def test_landed_keys_of_all_folders_and_sessions(spark, lake, size):
    land(lake, rows(spark, 0, 300))
    land(lake, rows(spark, 300, 600))
    land(lake, rows(spark, 600, 700), indexed=False)          # by a writer that keeps no index
    index_of(lake).stage(rows(spark, 700, 800))                # never committed
    batch = rows(spark, 650 - size, 650 + size)
    expected = sorted((f"p{i}", i % 3 + 1, f"h{i}") for i in range(max(650 - size, 0), min(650 + size, 700)))
    assert found(index_of(lake), batch) == expected
    other = Lake(spark.newSession(), lake.root)
    spark.sql(f"DROP TABLE {index_of(lake).name}")             # as in a new application: files and commits only
    assert found(index_of(other), other.spark.createDataFrame(batch.toPandas(), SCHEMA)) == expected


def test_few_keys_read_only_their_buckets(spark, lake):
    land(lake, rows(spark, 0, 600))
    index = index_of(lake)
    text = plan(index.landed(rows(spark, 10, 12)))
    assert "tables/raw_payment_versions" not in text and "Exchange" not in text
    assert "PushedFilters: [In(key_text" in text
    # files of other buckets are never opened: they can be anything
    wanted = {"p10", "p11"}
    for file in glob.glob(f"{lake.root}/keys/raw_payment_versions/token=*/*.parquet"):
        if not wanted & set(pq.read_table(file, columns=["payment_id"]).column(0).to_pylist()):
            for path in (file, f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc"):
                with open(path, "wb") as f:
                    f.write(b"not parquet")
    assert found(index, rows(spark, 10, 12)) == [("p10", 2, "h10"), ("p11", 3, "h11")]
    with pytest.raises(Exception):
        index.landed(rows(spark, 0, 600)).collect()


def test_many_keys_join_without_moving_the_landed_side(spark, lake):
    land(lake, rows(spark, 0, 600))
    land(lake, rows(spark, 600, 900))
    batch = lake.scratch(rows(spark, 100, 800), "batch")[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = index_of(lake).landed(batch)
        text = plan(joined)
        assert joined.count() == 700
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Bucketed: true") == 1
    assert text.count("Exchange hashpartitioning") == 1        # the batch's keys, into the table's buckets
    assert "tables/raw_payment_versions" not in text


def test_ingestion_classifies_from_the_index_alone(spark, lake, monkeypatch):
    from tidemark.plans.ingest import PaymentIngestion
    record = {"payment_id": "x1", "order_id": "o1", "version": 1, "amount": "5.00", "currency": "IDR", "status": "succeeded",
              "updated_at": "2026-02-01T08:00:00+07:00"}
    pages = spark.createDataFrame([("p0", 0, json.dumps({"data": [record], "next_cursor": None}))],
                                  "page_id string, page_seq bigint, page string")
    assert PaymentIngestion(lake).run(pages)["payments_inserted"] == 1
    read = lake.read
    monkeypatch.setattr(lake, "read", lambda table, *a, **k: pytest.fail("log read") if table == "raw_payment_versions" else read(table, *a, **k))
    assert PaymentIngestion(lake).run(pages)["payments_inserted"] == 0
