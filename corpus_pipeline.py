"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs.  All but the last return the columns of documents.  Tokenising and
learned scores are beyond SQL, so ORACLE_SQL is None; tests hold the stages against brute force.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import lines, mixing, packing, parity, quality
from tidemark.session import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score under 0.7) go."""
    return quality.keep_good(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in five documents stay in the last one only; texts may get empty, rows stay."""
    out = lines.dedup_lines(docs, carried=("lang", "source"))
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source",
                      F.char_length("kept_text").cast("long").alias("n_chars"))


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays, the one with the smallest id."""
    out = parity.one_of_each(docs, carried=("lang", "source"))
    return out.select(*COLUMNS[:4], F.char_length("text").cast("long").alias("n_chars"))


def mixing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: repeated rows are repeated documents."""
    return mixing.mixed(docs.select(*COLUMNS))


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("mixing sources", mixing_stage),
    ("best-fit packing", packing_stage),
]

ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
