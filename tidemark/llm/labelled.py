"""What the two classifiers share: the labelled sample, the model's way through Spark, the split."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import arrays as A

#: Labelled rows that a classifier is fitted on at most (the smallest by a hash of the id).
SAMPLE_ROWS = 20_000


def held_out():
    """Rows whose crc32 of the id's text leaves 2 modulo 4; false for null ids."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, bound: int = SAMPLE_ROWS) -> DataFrame:
    """(text, label) of at most ``bound`` labelled rows outside the held-out part.

    Labels other than 0 and 1, and null ids, take no part.  Only ids of the sample (16 bytes
    each, so 320 kB at the default bound) are broadcast; texts are not shuffled.
    """
    ids = (labels.where(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
           .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(bound))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(ids), "doc_id").select("text", "label")


def fit(sample: DataFrame, train: Callable[[Iterator], object]) -> object:
    """Run ``train`` over (bytes, borders, labels) slices of the bounded sample, in one task; rows
    reach it in an order of their own, so a rerun gives the same model."""
    @A.trimmed
    def task(batches):
        def slices():
            for batch in batches:
                label = batch.column("label").to_numpy()
                for first, end, data, borders in A.text_slices(batch.column("text")):
                    yield data, borders, label[first:end]

        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(slices()))], pa.binary())], names=["model"])

    # sort keys are sampled on the driver, so they hold a digest, not the text
    ordered = sample.orderBy(F.xxhash64("text"), F.sha2(F.col("text").cast("binary"), 256), "label").coalesce(1)
    row = ordered.mapInArrow(task, "model binary").first()
    return pickle.loads(row[0]) if row else train(iter(()))  # an empty sample may have no task


def score_rows(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray], np.ndarray], limit: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; no shuffle, texts stay in their task."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    @A.trimmed
    def task(batches):
        for batch in batches:
            parts = [score(data, borders) for _, _, data, borders in A.text_slices(batch.column("text"))]
            if parts:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"),
                                                  pa.array(np.concatenate(parts), pa.float64())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(task, "doc_id long, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= limit).cast("int"))


def keep_rows(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray], np.ndarray], limit: float) -> DataFrame:
    """The rows, all columns, that score ``limit`` or more; no shuffle."""
    @A.trimmed
    def task(batches):
        for batch in batches:
            parts = [score(data, borders) for _, _, data, borders in A.text_slices(batch.column("text"))]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts) >= limit))

    return docs.mapInArrow(task, docs.schema)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
