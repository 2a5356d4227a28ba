"""Click events: publish (S5), bounded read (S4) and idempotent landing.

The source is Kafka when its connector is on the classpath, a topic folder with
real offsets (``streaming/topic.py``), or a file stream of the same column set:
key, value, topic, partition, offset, timestamp.  Everything after ``read_clicks``
is shared.  A drain of a topic folder can be bounded (T4): ``consume`` stops after
``max_messages`` records, on the very record, or when none came for ``idle_seconds``.

Landing runs in ``foreachBatch``: the micro-batch is parsed and checked with
column expressions (V5), canonicalised and hashed (P1, P2), classified against
the landed events by ``event_id`` (J4; the first delivery by offset decides and
a later one that differs is a conflict, wherever the batches end -- T2), written
once, and published by one lake commit that records the stream's batch id.  A
replayed batch id is skipped (T1), so Spark's at-least-once delivery cannot land
a row twice; offsets are committed by Spark only after ``foreachBatch`` returns.
A batch that finds other events published meanwhile is classified again.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .. import schemas
from ..functions.canonical import canonical_free_json, payload_hash
from ..functions.contracts import CLICK_TYPES, _probe, _probe_cleanup, failures, parse_ok
from ..functions.timeutil import has_zone
from ..operators.versions import CONFLICT, NEW, classify_copies
from ..sources.keyindex import KeyIndex
from ..sources.lake import ConcurrentCommit, Lake
from . import topic as topics

TOPIC = "tidemark.clickstream"
TOPIC_PARTITIONS = 3
KAFKA_COLUMNS = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
STREAM = "clickstream"
REASONS = ("invalid_clickstream_json", "invalid_clickstream_contract", "clickstream_payload_conflict")


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def publish(records: DataFrame, target: dict) -> int:
    """Write (key, value) records to the topic; returns the count.

    ``target`` is Kafka options (``kafka.bootstrap.servers``), ``{"topic_path":
    dir}`` for a topic folder, which assigns offsets in the order of the records'
    ``offset`` column, or ``{"path": dir}`` for the file form, whose records carry
    partition and offset themselves."""
    if "topic_path" in target:
        return topics.publish(records, target["topic_path"], target.get("topic", TOPIC), ("offset",))
    sent = Observation()
    records = records.observe(sent, F.count(F.lit(1)).alias("records"))
    if "kafka.bootstrap.servers" in target:
        (records.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", target["kafka.bootstrap.servers"])
         .option("topic", target.get("topic", TOPIC)).save())
    else:
        records.select("key", "value", F.lit(target.get("topic", TOPIC)).alias("topic"),
                       "partition", "offset", "timestamp").write.mode("append").json(target["path"])
    return int(sent.get["records"])


def read_clicks(spark: SparkSession, options: dict) -> DataFrame:
    """A bounded-per-trigger stream of topic records from the earliest offset."""
    if "kafka.bootstrap.servers" in options:
        if not kafka_available(spark):
            raise RuntimeError("the Kafka connector is not on the classpath")
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", options["kafka.bootstrap.servers"])
                .option("subscribe", options.get("topic", TOPIC))
                .option("startingOffsets", "earliest")
                .option("maxOffsetsPerTrigger", str(options.get("max_messages", 100000)))
                .load()
                .selectExpr("cast(key as string) as key", "cast(value as string) as value", "topic",
                            "partition", "offset", "timestamp"))
    if "topic_path" in options:
        return topics.read_stream(spark, options["topic_path"], start=json.dumps(options.get("start", {})),
                                  limits=json.dumps({"total": options.get("total"), "batch": options.get("batch")}))
    return (spark.readStream.schema(KAFKA_COLUMNS)
            .option("maxFilesPerTrigger", str(options.get("max_files", 1)))
            .json(options["path"]))


def check_clicks(batch: DataFrame) -> DataFrame:
    """Parse and V5-check topic records; adds ``bad_json``, ``invalid_fields``, ``payload``."""
    names = ["event_id", "customer_id", "event_type", "event_time"]
    p = _probe(batch, F.try_parse_json(F.col("value")), names)

    def empty(n):
        return F.col(f"_s_{n}").isNull() | (F.length(F.col(f"_s_{n}")) == 0)
    errs = failures(("event_id", empty("event_id")), ("customer_id", empty("customer_id")),
                    ("event_type", empty("event_type")
                     | ~F.coalesce(F.col("_s_event_type").isin(*CLICK_TYPES), F.lit(False))),
                    ("event_time", ~F.coalesce(has_zone(F.col("_s_event_time")) & parse_ok(F.col("_s_event_time")), F.lit(False))))
    out = p.select("*", F.col("_m").isNull().alias("bad_json"), errs.alias("invalid_fields"),
                   F.col("_s_event_id").alias("event_id"),
                   canonical_free_json(F.col("value")).alias("payload"))
    return _probe_cleanup(out)


class ClickSink:
    """``foreachBatch`` target.  ``on_bad``: ``fail`` (parity, T3: bad JSON, a bad
    contract or a conflict stops the stream before its offsets commit) or
    ``quarantine`` (bad records go to a side table, the stream continues)."""

    def __init__(self, lake: Lake, on_bad: str = "fail", stream_id: str = STREAM):
        if on_bad not in ("fail", "quarantine"):
            raise ValueError("on_bad must be fail or quarantine")
        # batch ids restart at 0 for every new checkpoint, so replay markers are
        # kept per stream (its checkpoint location)
        self.lake, self.on_bad, self.stream_id = lake, on_bad, stream_id
        self.index = KeyIndex(lake, "clickstream_events", schemas.CLICKSTREAM_EVENTS, ("event_id",))
        self.counters = {"received": 0, "inserted": 0, "duplicates": 0, "quarantined": 0}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # the micro-batch is written once; every later step reads the files
        checked, received = self.lake.scratch(check_clicks(batch), f"clicks-{batch_id}")
        while True:
            try:
                return self._land(checked, received, batch_id)
            except ConcurrentCommit:
                continue   # another drain published events: classify against them

    def _land(self, checked: DataFrame, received: int, batch_id: int) -> None:
        since = self.lake.last_commit()
        if batch_id in self.lake.batch_ids(self.stream_id):
            return  # replay of a committed batch
        broken = F.col("bad_json") | (F.size("invalid_fields") > 0)
        rows = checked.where(~broken).select(
            "event_id", F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
            "topic", "value", "payload", payload_hash(F.col("payload")).alias("payload_hash"))
        landed = self.index.landed(rows)
        labelled, _ = self.lake.scratch(
            classify_copies(rows, landed, ["event_id"], ("kafka_offset", "kafka_partition"))
            .withColumn("ingested_at", F.current_timestamp()), f"clicks-{batch_id}-labelled")
        refused = checked.where(broken).select(
            "topic", F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
            "value", F.when(F.col("bad_json"), F.lit("invalid_clickstream_json"))
                      .otherwise(F.lit("invalid_clickstream_contract")).alias("reason"),
            F.current_timestamp().alias("ingested_at")).unionByName(
            labelled.where(F.col("status") == CONFLICT).select(
                "topic", "kafka_partition", "kafka_offset", "value",
                F.lit("clickstream_payload_conflict").alias("reason"), "ingested_at"))
        quarantined = self.lake.stage("click_quarantine", refused)
        by_reason = {r["reason"]: r["count"] for r in self.lake.spark.read.schema(schemas.CLICK_QUARANTINE)
                     .parquet(f"{self.lake.root}/tables/click_quarantine/{quarantined}")
                     .groupBy("reason").count().collect()}   # three reasons at most
        if self.on_bad == "fail":
            for reason in REASONS:
                if reason in by_reason:
                    raise ValueError(reason)
        new = labelled.where(F.col("status") == NEW)
        inserted = new.count()
        staged = {}
        if by_reason:
            staged["click_quarantine"] = [quarantined]
        if inserted:
            staged["clickstream_events"] = [self.lake.stage("clickstream_events", new.select(
                *schemas.CLICKSTREAM_EVENTS.fieldNames()))]
            staged[self.index.entry] = [self.index.stage(new)]
        # how far the landed batches reach, per topic partition
        through = {str(r["partition"]): r["end"] for r in checked.groupBy("partition")
                   .agg((F.max("offset") + 1).alias("end")).collect()}   # one row per topic partition
        self.lake.commit(staged, info={"event": "clicks", "through": through}, batch=(self.stream_id, batch_id),
                         guard=("clickstream_events",), since=since)
        bad = sum(by_reason.values())
        for name, n in (("received", received), ("inserted", inserted), ("quarantined", bad),
                        ("duplicates", received - inserted - bad)):
            self.counters[name] += n


def landed_through(lake: Lake, stream_id: str) -> dict[str, int]:
    """The offsets after the last landed record of a stream, per partition."""
    out: dict[str, int] = {}
    for c in lake.commits():
        if c.meta.get("batch") and c.meta["batch"][0] == stream_id:
            for p, end in c.meta["info"].get("through", {}).items():
                out[p] = max(end, out.get(p, 0))
    return out


class DrainListener(StreamingQueryListener):
    """How far one query has come; Spark reports a batch after its offsets are committed."""

    def __init__(self):
        self.run_id, self.reached, self.last = None, 0, None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if str(event.progress.runId) != self.run_id:
            return
        for source in event.progress.sources:
            self.reached = sum(json.loads(source.endOffset or "{}").values())
        if event.progress.numInputRows or self.last is None:
            self.last = time.monotonic()

    def onQueryIdle(self, event):
        if str(event.runId) == self.run_id and self.last is None:   # the idle clock starts with the first look
            self.last = time.monotonic()

    def onQueryTerminated(self, event):
        pass


def consume(spark: SparkSession, lake: Lake, source: dict, checkpoint: str, on_bad: str = "fail",
            max_messages: int | None = None, idle_seconds: float | None = None) -> dict:
    """T4: drain what is available now, then stop; from a topic folder also bounded: stop after ``max_messages``
    records, or when none came for ``idle_seconds``.  Offsets are committed up to the bound and not beyond, so the
    next call goes on with the next record."""
    if any(b is not None and b <= 0 for b in (max_messages, idle_seconds)):
        raise ValueError("the bounds of a drain are above zero")
    sink = ClickSink(lake, on_bad, stream_id=f"{STREAM}@{checkpoint}")
    if "topic_path" in source:
        _drain_topic(spark, sink, source, checkpoint, max_messages, idle_seconds)
    elif max_messages is not None or idle_seconds is not None:
        raise ValueError("only a topic folder is drained up to a bound")
    else:
        q = (read_clicks(spark, source).writeStream.foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return sink.counters


def _drain_topic(spark: SparkSession, sink: ClickSink, source: dict, checkpoint: str, total: int | None,
                 idle_seconds: float | None, poll_seconds: float = 0.2) -> None:
    start = landed_through(sink.lake, sink.stream_id)
    if idle_seconds is None:   # what is there now, or less
        here = topics.heads(topics.segments(source["topic_path"]))
        available = sum(end - start.get(p, 0) for p, end in here.items())
        total = available if total is None else min(total, available)
        if not total:
            return
    listener = DrainListener()
    spark.streams.addListener(listener)
    try:
        q = (read_clicks(spark, {**source, "start": start, "total": total}).writeStream.foreachBatch(sink)
             .option("checkpointLocation", checkpoint)
             .trigger(processingTime=f"{int(poll_seconds * 1000)} milliseconds").start())
        listener.run_id = str(q.runId)
        while not q.awaitTermination(poll_seconds):
            # the reader plans no record past the bound, so a stop cuts nothing short
            enough = total is not None and listener.reached - sum(start.values()) >= total
            idle = (idle_seconds is not None and listener.last is not None and not q.status["isTriggerActive"]
                    and time.monotonic() - listener.last > idle_seconds)
            if enough or idle:
                q.stop()
        if q.exception() is not None:
            raise q.exception()
    finally:
        spark.streams.removeListener(listener)


def landed_clicks(lake: Lake) -> DataFrame:
    return lake.read("clickstream_events", schemas.CLICKSTREAM_EVENTS)
