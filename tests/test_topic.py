"""The topic folder as a streaming source: offsets, bounded drains, batches killed at either side of their commit."""

import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import clicks as st
from tidemark.streaming import topic

EVENTS = [{"event_id": f"own-{k}", "customer_id": f"c{k % 5}", "event_type": ("page_view", "checkout")[k % 2],
           "event_time": f"2026-03-0{1 + k % 9}T10:00:00+07:00"} for k in range(15)]


def publish(spark, path, events, first=0):
    rows = [(e["customer_id"], json.dumps(e), k % 3, first + k) for k, e in enumerate(events)]
    records = spark.createDataFrame(rows, "key string, value string, partition int, offset long")
    return st.publish(records.withColumn("timestamp", F.timestamp_seconds(F.col("offset"))), {"topic_path": path})


@pytest.fixture()
def place():
    folder = tempfile.mkdtemp(prefix="tidemark-topic-")
    return f"{folder}/topic", os.path.join(folder, "checkpoint")


def landed(lake):
    return sorted((r["kafka_partition"], r["kafka_offset"], r["event_id"]) for r in st.landed_clicks(lake).collect())


def expected(events, first=0):
    return sorted((k % 3, first + k // 3, e["event_id"]) for k, e in enumerate(events))


def test_offsets_follow_the_order_of_publishing_without_gaps(spark, lake, place):
    path, checkpoint = place
    assert publish(spark, path, EVENTS[:6], first=100) == 6
    assert publish(spark, path, EVENTS[6:], first=7) == 9
    assert topic.heads(topic.segments(path)) == {"0": 5, "1": 5, "2": 5}
    counters = st.consume(spark, lake, {"topic_path": path}, checkpoint)
    assert counters == {"received": 15, "inserted": 15, "duplicates": 0, "quarantined": 0}
    assert landed(lake) == sorted(expected(EVENTS[:6]) + expected(EVENTS[6:], 2))
    assert st.consume(spark, lake, {"topic_path": path}, checkpoint)["received"] == 0


def test_a_drain_stops_on_the_record_and_the_next_one_goes_on(spark, lake, place):
    path, checkpoint = place
    publish(spark, path, EVENTS)
    first = st.consume(spark, lake, {"topic_path": path, "batch": 4}, checkpoint, max_messages=6, idle_seconds=60)
    assert (first["received"], first["inserted"]) == (6, 6)
    assert {o for _, o, _ in landed(lake)} == {0, 1}
    began = time.monotonic()
    rest = st.consume(spark, lake, {"topic_path": path}, checkpoint, max_messages=100, idle_seconds=1)
    assert (rest["received"], rest["inserted"]) == (9, 9) and time.monotonic() - began < 30
    assert landed(lake) == expected(EVENTS)


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_batch_killed_at_its_commit_lands_once(spark, lake, place, monkeypatch, when):
    path, checkpoint = place
    publish(spark, path, EVENTS)
    commit = lake.commit

    def killed(*args, **kwargs):
        if when == "after":
            commit(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "commit", killed)
    with pytest.raises(Exception, match="lost"):
        st.consume(spark, lake, {"topic_path": path}, checkpoint, max_messages=7, idle_seconds=60)
    monkeypatch.undo()
    publish(spark, path, EVENTS)   # every event once more, at later offsets
    done = st.consume(spark, lake, {"topic_path": path}, checkpoint)
    assert landed(lake) == expected(EVENTS)
    assert done["inserted"] == (15 if when == "before" else 8)


def test_ranges_of_a_drain():
    assert topic.advance({}, {"0": 5, "1": 1, "2": 9}, 8) == {"0": 4, "1": 1, "2": 3}
    assert topic.advance({"0": 4}, {"0": 5, "1": 0}, 8) == {"0": 5, "1": 0}
    assert topic.advance({"0": 2}, {"0": 5}, None) == {"0": 5}


def test_bounds_need_a_topic_folder(spark, lake, place):
    with pytest.raises(ValueError):
        st.consume(spark, lake, {"path": place[0]}, place[1], max_messages=6)
    with pytest.raises(ValueError):
        st.consume(spark, lake, {"topic_path": place[0]}, place[1], max_messages=0)
