"""Keyed index of what has landed (J4, I1, I7, T1): classify a batch without reading the log.

Beside every landed folder a run stages the folder's keys and hashes as one partition of a bucketed table: a
narrow row (key text, key columns, hash), clustered and sorted by the key text, with Parquet Bloom filters on it.
A commit names the partition as it names the folder, so an index partition is visible exactly when its rows are.

A batch of few keys is probed by value: Spark reads only the buckets these hash to, and in them only row groups
whose range and Bloom filter admit a key.  A larger batch is joined bucket by bucket: its own keys are shuffled
into the table's buckets, the landed side is not shuffled at all.  Folders landed without an index partition
(by another writer) are read themselves, so the result never depends on the index being complete.

The number of buckets is fixed when a lake first indexes a table and kept beside it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.canonical import packed_hash, unpacked_hash
from .lake import Lake

BUCKETS = 16
#: A batch of at most so many distinct keys is probed by value.
PROBE_KEYS = 128


def key_text(keys: Sequence[str]) -> Column:
    """One text per key that no other key has (each part with its length)."""
    parts = [c for k in keys for c in (F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string"))]
    return F.concat(*parts)


class KeyIndex:
    def __init__(self, lake: Lake, table: str, schema: StructType, keys: Sequence[str], hash_col: str = "payload_hash",
                 buckets: int = BUCKETS):
        self.lake, self.spark, self.table, self.schema = lake, lake.spark, table, schema
        self.keys, self.hash_col = list(keys), hash_col
        self.entry = f"{table}#keys"   # the name of its partitions in commits
        self.path = lake.fs.qualify(f"{lake.root}/keys/{table}")
        self.name = f"tidemark_keys_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"
        self._wanted = buckets

    def _open(self) -> None:
        """Declare the table in this session's catalog; files and bucket count are the lake's."""
        if self.spark.catalog.tableExists(self.name):
            return
        self.lake.fs.mkdirs(self.path)
        self.lake.fs.create_new(f"{self.path}.json", json.dumps({"buckets": self._wanted}))
        buckets = self._buckets()
        types = {f.name: f.dataType.simpleString() for f in self.schema.fields}
        columns = ", ".join(f"`{c}` {types[c]}" for c in (*self.keys, self.hash_col))
        self.spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.name} (key_text STRING, {columns}, token STRING) USING parquet
            OPTIONS ('compression' 'zstd', 'parquet.bloom.filter.enabled#key_text' 'true', 'parquet.bloom.filter.adaptive.enabled' 'true') PARTITIONED BY (token)
            CLUSTERED BY (key_text) SORTED BY (key_text) INTO {buckets} BUCKETS LOCATION '{self.path}'""")

    def _buckets(self) -> int:
        return int(json.loads(self.lake.fs.read_text(f"{self.path}.json"))["buckets"])

    def stage(self, rows: DataFrame) -> str:
        """Write the keys of rows about to be committed; returns the partition for the commit's ``entry``."""
        self._open()
        token = uuid.uuid4().hex
        hash_col = F.col(self.hash_col)
        # the key text is made again behind the shuffle
        (rows.select(*self.keys, packed_hash(hash_col).alias(self.hash_col)).repartition(self._buckets(), key_text(self.keys))
             .select(key_text(self.keys).alias("key_text"), *self.keys, unpacked_hash(hash_col).alias(self.hash_col),
                     F.lit(token).alias("token")).write.insertInto(self.name))
        return token

    def _partitions(self, commits) -> tuple[list[str], list]:
        """(index partitions, commits that landed rows without one)."""
        tokens, bare = [], []
        for c in commits:
            found = c.meta.get("tables", {})
            tokens += found.get(self.entry, [])
            if found.get(self.table) and not found.get(self.entry):
                bare.append(c)
        return tokens, bare

    def _declare(self, tokens: list[str]) -> None:
        """Partitions of other sessions are made known to this one's catalog."""
        known = {r[0].partition("=")[2] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()}
        missing = [t for t in tokens if t not in known]
        for at in range(0, len(missing), 500):
            parts = " ".join(f"PARTITION (token='{t}')" for t in missing[at: at + 500])
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {parts}")

    def landed(self, batch: DataFrame) -> DataFrame:
        """(keys, hash) of the landed rows whose key occurs in the batch."""
        commits = self.lake.commits()
        tokens, bare = self._partitions(commits)
        columns = [*self.keys, self.hash_col]
        out = None
        wanted = batch.select(key_text(self.keys).alias("key_text"))
        if tokens:
            self._open()
            self._declare(tokens)
            rows = self.spark.table(self.name).where(F.col("token").isin(tokens))
            # an estimate in one pass: only a batch that may have few keys is made distinct
            few = None
            if wanted.agg(F.approx_count_distinct("key_text")).first()[0] <= 2 * PROBE_KEYS:
                few = [r[0] for r in wanted.distinct().limit(PROBE_KEYS + 1).collect()]
            if few is not None and len(few) <= PROBE_KEYS:
                rows = rows.where(F.col("key_text").isin(few))
            else:
                rows = rows.join(wanted, "key_text", "left_semi")
            out = rows.select(*columns)
        if bare or out is None:
            rows = self.lake.read(self.table, self.schema, commits=bare).select(*columns)
            rows = rows.join(batch.select(*self.keys), self.keys, "left_semi")
            out = rows if out is None else out.unionByName(rows)
        return out
