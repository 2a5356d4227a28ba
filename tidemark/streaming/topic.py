"""A partitioned topic in a shared folder, as a streaming source with offsets.

Layout under the topic's folder::

    segments/<token>/partition=<p>/part-*.parquet    records in order: key, value, timestamp
    _index/<n>.json                                  the files of one publish, in order, with their rows

A record's offset is the rows published to its partition before its file, plus its place in the file, so offsets
have no gaps and publishing ranks nothing across files.  A publish appears whole when its index file does, never
over an existing one; of two publishers racing for a number the later one takes the next and its offsets follow.

``TopicSource`` (format ``tidemark_topic``) is a Python data source over the folder: the driver plans offset
ranges from the index alone, one input partition per file and range, and executors read only those files.
Options: ``path``; ``start`` and ``limits`` (JSON) for a bounded drain, see ``TopicReader``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..sources.lake import FileSystem

FORMAT = "tidemark_topic"
RECORD = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def publish(records: DataFrame, path: str, topic: str, order: tuple[str, ...] = ("timestamp",)) -> int:
    """Append (key, value, partition, timestamp) records, in ``order`` within a partition; returns their number.

    Records are dealt by ranges of (partition, order), so a busy partition is written by several tasks.
    """
    spark, token = records.sparkSession, uuid.uuid4().hex
    fs = FileSystem(spark, path)
    folder = f"{path}/segments/{token}"
    (records.select("key", "value", F.col("partition").cast("int").alias("partition"), F.col("timestamp").cast("timestamp").alias("timestamp"),
                    F.struct(*order).alias("_order"))
     .repartitionByRange("partition", "_order").sortWithinPartitions("partition", "_order").drop("_order")
     .write.partitionBy("partition").parquet(folder))
    rows = spark.read.schema("key string, partition int").option("basePath", folder).parquet(folder)
    counted = rows.groupBy("partition", F.col("_metadata.file_name").alias("name")).count()   # one row per file
    files = [[int(r["partition"]), f"segments/{token}/partition={r['partition']}/{r['name']}", int(r["count"])]
             for r in sorted(counted.collect(), key=lambda r: (r["partition"], r["name"]))]
    fs.mkdirs(f"{path}/_index")
    text = json.dumps({"topic": topic, "files": files})
    while True:
        numbers = [int(n[:-5]) for n in fs.list_names(f"{path}/_index") if n.endswith(".json") and not n.startswith(".")]
        if fs.create_new(f"{path}/_index/{max(numbers, default=0) + 1:012d}.json", text):
            return sum(f[2] for f in files)


@dataclass(frozen=True)
class Segment:
    partition: int
    path: str
    topic: str
    first: int   # offset of its first record
    rows: int


def segments(path: str) -> list[Segment]:
    """All published files in order of offset, from the index (one small file per publish)."""
    from pyarrow import fs as afs

    store, root = afs.FileSystem.from_uri(path)
    names = sorted(f.path for f in store.get_file_info(afs.FileSelector(f"{root}/_index", allow_not_found=True))
                   if f.base_name.endswith(".json") and not f.base_name.startswith("."))
    out, ends = [], {}
    for name in names:
        with store.open_input_stream(name) as stream:
            index = json.loads(stream.read())
        for partition, file, rows in index["files"]:
            first = ends.get(partition, 0)
            out.append(Segment(partition, f"{path}/{file}", index["topic"], first, rows))
            ends[partition] = first + rows
    return out


def heads(found: list[Segment]) -> dict[str, int]:
    """The offset after the last record, per partition."""
    out: dict[str, int] = {}
    for s in found:
        out[str(s.partition)] = s.first + s.rows
    return out


def advance(start: dict, end: dict, limit: int | None) -> dict:
    """From ``start`` at most ``limit`` records on towards ``end``, the partitions in equal steps."""
    at = {p: max(int(start.get(p, 0)), 0) for p in end}
    left = sum(end[p] - at[p] for p in end) if limit is None else limit
    while left > 0:
        open_ = sorted((p for p in end if at[p] < end[p]), key=int)
        if not open_:
            break
        share = max(left // len(open_), 1)
        for p in open_:
            step = min(share, end[p] - at[p], left)
            at[p] += step
            left -= step
    return at


class TopicSlice(InputPartition):
    def __init__(self, segment: Segment, skip: int, rows: int):
        self.segment, self.skip, self.rows = segment, skip, rows


class TopicReader(DataSourceStreamReader):
    """Offsets per partition.  ``limits`` is {"total": n or null, "batch": n or null}: the reader never plans past
    ``total`` records after ``start`` (where the drain begins), and a micro-batch ends ``batch`` records on."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        limits = json.loads(options.get("limits", "{}"))
        self.total, self.batch = limits.get("total"), limits.get("batch")
        self.start = json.loads(options.get("start", "{}"))
        self.at = dict(self.start)

    def initialOffset(self) -> dict:
        return {p: 0 for p in heads(segments(self.path))}

    def latestOffset(self) -> dict:
        end = heads(segments(self.path))
        if self.total is not None:
            end = advance(self.start, end, self.total)
        self.at = advance(self.at, end, self.batch)
        return self.at

    def partitions(self, start: dict, end: dict) -> list[TopicSlice]:
        out = []
        for s in segments(self.path):
            low = max(int(start.get(str(s.partition), 0)), s.first)
            high = min(int(end.get(str(s.partition), 0)), s.first + s.rows)
            if low < high:
                out.append(TopicSlice(s, low - s.first, high - low))
        self.at = {p: max(int(end.get(p, 0)), int(self.at.get(p, 0))) for p in {*end, *self.at}}
        return out

    def read(self, partition: TopicSlice) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs as afs

        s, at, last = partition.segment, 0, partition.skip + partition.rows
        store, file = afs.FileSystem.from_uri(s.path)
        with store.open_input_file(file) as stream:
            for batch in pq.ParquetFile(stream).iter_batches(columns=["key", "value", "timestamp"]):
                low, high = max(partition.skip - at, 0), min(last - at, batch.num_rows)
                if low < high:
                    part, n = batch.slice(low, high - low), high - low
                    yield pa.RecordBatch.from_arrays(
                        [part.column("key"), part.column("value"), pa.array([s.topic] * n, pa.string()),
                         pa.array([s.partition] * n, pa.int32()), pa.array(range(s.first + at + low, s.first + at + high), pa.int64()),
                         part.column("timestamp").cast(pa.timestamp("us", "UTC"))],
                        names=["key", "value", "topic", "partition", "offset", "timestamp"])
                at += batch.num_rows
                if at >= last:
                    return


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return RECORD

    def streamReader(self, schema) -> TopicReader:
        return TopicReader(dict(self.options))


def read_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The topic from its first offset, or from where the query's checkpoint ends."""
    spark.dataSource.register(TopicSource)
    return spark.readStream.format(FORMAT).options(path=path, **options).load()
