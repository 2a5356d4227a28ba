"""Incremental ingestion, backfill, conflicts, payments pages, click stream."""

import json
import os
import tempfile
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import CLICKS, ORDER_SCHEMA, ORDERS, PAYMENT_RECORDS, frame
from tidemark import schemas
from tidemark.plans.ingest import OrderIngestion, PaymentIngestion, landed_orders, landed_payments, latest_runs
from tidemark.sources.lake import ConcurrentCommit
from tidemark.streaming import clicks as st

JKT = timezone(timedelta(hours=7))
CUTOFF = datetime(2026, 9, 28, 10, 20, tzinfo=JKT)


def source(spark, rows=ORDERS):
    return frame(spark, rows, ORDER_SCHEMA)


def test_first_load_rerun_backfill_and_empty_window(spark, lake):
    ing = OrderIngestion(lake, source(spark))
    r = ing.run(CUTOFF)
    assert (r["extracted"], r["inserted"]) == (8, 8) and ing.checkpoint() == CUTOFF
    r = ing.run(CUTOFF)   # the 15-minute lookback re-reads two rows, inserts none
    assert (r["extracted"], r["inserted"], r["duplicates"]) == (2, 0, 2)
    r = ing.backfill(datetime(2026, 1, 1, tzinfo=timezone.utc), CUTOFF)
    assert r["inserted"] == 0 and not r["checkpoint_advanced"] and ing.checkpoint() == CUTOFF
    later = CUTOFF + timedelta(hours=2)
    r = ing.run(later)
    assert (r["extracted"], r["inserted"]) == (2, 0) and ing.checkpoint() == later
    latest = later + timedelta(hours=1)
    r = ing.run(latest)   # an empty window still advances the checkpoint
    assert r["extracted"] == 0 and ing.checkpoint() == latest
    with pytest.raises(ValueError, match="that is a backfill"):
        ing.run(CUTOFF)
    assert landed_orders(lake).count() == 8


def test_conflict_is_refused_and_ledgered(spark, lake):
    OrderIngestion(lake, source(spark)).run(CUTOFF)
    changed = [tuple(r) if r[0] != "ord-1001" else r[:3] + (Decimal("1.00"),) + r[4:] for r in ORDERS]
    ing = OrderIngestion(lake, source(spark, changed))
    with pytest.raises(ValueError, match="order_version_payload_conflict"):
        ing.backfill(datetime(2026, 1, 1, tzinfo=timezone.utc), CUTOFF)
    conflicts = lake.read("order_conflicts", schemas.ORDER_CONFLICTS).collect()
    assert len(conflicts) == 1 and conflicts[0]["order_id"] == "ord-1001"
    assert conflicts[0]["reason_code"] == "same_version_different_payload"
    assert landed_orders(lake).count() == 8 and ing.checkpoint() == CUTOFF
    runs = {r["status"] for r in latest_runs(lake).collect()}
    assert runs == {"succeeded", "failed"}


def test_uncommitted_data_is_invisible(spark, lake):
    """A crash between the data write and the commit leaves readers unchanged."""
    OrderIngestion(lake, source(spark)).run(CUTOFF)
    lake.stage("raw_order_versions", landed_orders(lake))   # written, never committed
    assert landed_orders(lake).count() == 8


def test_second_writer_takes_the_next_number_unless_guarded(spark, lake):
    n = lake.last_commit() + 1
    assert lake.fs.create_new(f"{lake.root}/_commits/{n:020d}.json", json.dumps({"tables": {"checkpoints": []}}))
    seen, plain = [], lake.last_commit

    def stale_once():    # a writer that read the commit number before the other won
        seen.append(1)
        return n - 1 if len(seen) == 1 else plain()
    lake.last_commit = stale_once
    empty = spark.createDataFrame([], schemas.CHECKPOINTS)
    assert lake.append({"checkpoints": empty}) == n + 1
    lake.last_commit = plain
    with pytest.raises(ConcurrentCommit):
        lake.commit({}, guard=("checkpoints",), since=n - 1)


def test_run_failure_marks_run_failed(spark, lake):
    bad = source(spark).withColumn("order_id", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="metadata is NULL"):
        OrderIngestion(lake, bad).run(CUTOFF)
    r = latest_runs(lake).first()
    assert r["status"] == "failed" and r["error_code"] == "ValueError" and landed_orders(lake).count() == 0


def pages_of(spark, records, size=2):
    pages = []
    for i in range(0, len(records), size):
        nxt = f"p{i // size + 1}" if i + size < len(records) else None
        pages.append((f"p{i // size}", i // size, json.dumps({"data": records[i:i + size], "next_cursor": nxt})))
    return spark.createDataFrame(pages, "page_id string, page_seq bigint, page string")


def test_payment_pages_replay_conflict_and_bad_page(spark, lake):
    ing = PaymentIngestion(lake)
    r = ing.run(pages_of(spark, PAYMENT_RECORDS))
    assert (r["pages_fetched"], r["payments_received"], r["payments_inserted"]) == (3, 6, 6)
    assert ing.run(pages_of(spark, PAYMENT_RECORDS))["payments_inserted"] == 0
    changed = [dict(p, amount="1.00") if p["payment_id"] == "pay-1" else p for p in PAYMENT_RECORDS]
    with pytest.raises(ValueError, match="payment_version_payload_conflict"):
        ing.run(pages_of(spark, changed))
    assert landed_payments(lake).count() == 6


def test_one_bad_payment_refuses_its_page(spark, lake):
    recs = [dict(p, payment_id=f"new-{i}") for i, p in enumerate(PAYMENT_RECORDS)]
    recs[3] = dict(recs[3], version=True)           # page p1 is bad
    with pytest.raises(ValueError, match="invalid_payment_contract"):
        PaymentIngestion(lake).run(pages_of(spark, recs))
    assert sorted(r["payment_id"] for r in landed_payments(lake).collect()) == ["new-0", "new-1"]


def test_feed_shape_and_repeated_cursor(spark, lake):
    bad = spark.createDataFrame([("p0", 0, '{"data": 5, "next_cursor": null}')], "page_id string, page_seq bigint, page string")
    with pytest.raises(ValueError, match="invalid_response_shape"):
        PaymentIngestion(lake).run(bad)
    loop = spark.createDataFrame([("p0", 0, '{"data": [], "next_cursor": "x"}'), ("p1", 1, '{"data": [], "next_cursor": "x"}')],
                                 "page_id string, page_seq bigint, page string")
    with pytest.raises(ValueError, match="repeated_cursor"):
        PaymentIngestion(lake).run(loop)


def click_records(spark, clicks, first_offset=0):
    rows = [(c["customer_id"], json.dumps(c), 0, first_offset + i, None) for i, c in enumerate(clicks)]
    return spark.createDataFrame(rows, "key string, value string, partition int, offset bigint, timestamp timestamp")


def test_click_stream_replay_and_conflict(spark, lake):
    topic = tempfile.mkdtemp(prefix="topic-")
    ckpt = os.path.join(tempfile.mkdtemp(prefix="ckpt-"), "c")
    assert st.publish(click_records(spark, CLICKS), {"path": topic}) == 6
    c1 = st.consume(spark, lake, {"path": topic}, ckpt)
    assert (c1["received"], c1["inserted"]) == (6, 6)
    # a replay of the same events: at-least-once delivery lands nothing new
    st.publish(click_records(spark, CLICKS[:1], 100), {"path": topic})
    c2 = st.consume(spark, lake, {"path": topic}, ckpt)
    assert (c2["received"], c2["inserted"], c2["duplicates"]) == (1, 0, 1)
    st.publish(click_records(spark, [dict(CLICKS[0], event_type="checkout")], 200), {"path": topic})
    with pytest.raises(Exception, match="clickstream_payload_conflict"):
        st.consume(spark, lake, {"path": topic}, ckpt)
    assert st.landed_clicks(lake).count() == 6


def test_click_stream_bad_json_stops(spark, lake):
    topic = tempfile.mkdtemp(prefix="topic-")
    spark.createDataFrame([("k", "{not json", 0, 1, None)],
                          "key string, value string, partition int, offset bigint, timestamp timestamp") \
        .withColumn("topic", F.lit(st.TOPIC)).write.mode("append").json(topic)
    with pytest.raises(Exception, match="invalid_clickstream_json"):
        st.consume(spark, lake, {"path": topic}, os.path.join(tempfile.mkdtemp(), "c"))
    assert st.landed_clicks(lake).count() == 0


def test_click_stream_bad_contract_stops(spark, lake):
    topic = tempfile.mkdtemp(prefix="topic-")
    st.publish(click_records(spark, [dict(CLICKS[0], event_type="signup")]), {"path": topic})
    with pytest.raises(Exception, match="invalid_clickstream_contract"):
        st.consume(spark, lake, {"path": topic}, os.path.join(tempfile.mkdtemp(), "c"))
    assert st.landed_clicks(lake).count() == 0


def test_lake_constraints_hold_after_runs(spark, lake):
    from tidemark.plans.quality import lake_constraints
    ing = OrderIngestion(lake, source(spark))
    ing.run(CUTOFF)
    ing.run(CUTOFF)
    PaymentIngestion(lake).run(pages_of(spark, PAYMENT_RECORDS))
    res = {(r["table_name"], r["constraint_name"]): r["violations"] for r in lake_constraints(lake).collect()}
    assert res and all(v == 0 for v in res.values()), res
    assert ("raw_order_versions", "raw_order_pk") in res


def test_second_stream_on_same_lake_is_not_skipped(spark, lake):
    topic1, topic2 = tempfile.mkdtemp(prefix="topic-"), tempfile.mkdtemp(prefix="topic-")
    st.publish(click_records(spark, CLICKS[:3]), {"path": topic1})
    st.publish(click_records(spark, CLICKS[3:]), {"path": topic2})
    st.consume(spark, lake, {"path": topic1}, os.path.join(tempfile.mkdtemp(), "c"))
    c2 = st.consume(spark, lake, {"path": topic2}, os.path.join(tempfile.mkdtemp(), "c"))
    assert c2["inserted"] == 3 and st.landed_clicks(lake).count() == 6


def test_concurrent_run_of_same_pipeline_is_refused(spark, lake):
    """A run that publishes after another run landed rows since it started loses."""
    ing = OrderIngestion(lake, source(spark))
    other = OrderIngestion(lake, source(spark))
    orig_scratch = lake.scratch

    def interleave(df, name):
        lake.scratch = orig_scratch
        other.run(CUTOFF)            # the other runner publishes while this one is mid-run
        return orig_scratch(df, name)
    lake.scratch = interleave
    with pytest.raises(ConcurrentCommit, match="pipeline_already_running"):
        ing.run(CUTOFF)
    lake.scratch = orig_scratch
    assert landed_orders(lake).count() == 8      # no duplicates landed
    assert {r["status"] for r in latest_runs(lake).collect()} == {"succeeded", "failed"}


def feed_pages(spark, *bodies):
    """Landed pages p0, p1, ... in this order, of the given record lists."""
    rows = [(f"p{i * 8 + 2}", i, json.dumps({"data": recs, "next_cursor": f"p{i * 8 + 10}" if i + 1 < len(bodies) else None}))
            for i, recs in enumerate(bodies)]
    return spark.createDataFrame(rows, "page_id string, page_seq bigint, page string")


def landed_places(lake):
    return {r["payment_id"]: r["page_id"] for r in landed_payments(lake).collect()}


@pytest.mark.parametrize("on_bad", ["fail", "quarantine"])
def test_a_copy_on_a_refused_page_takes_nothing_from_the_first_page(spark, lake, on_bad):
    a, b, c = (dict(PAYMENT_RECORDS[0], payment_id=f"copy-{i}") for i in range(3))
    pages = feed_pages(spark, [a, b], [a, dict(c, version=True)])    # ids p2 and p10: text order differs
    if on_bad == "fail":
        with pytest.raises(ValueError, match="invalid_payment_contract"):
            PaymentIngestion(lake, on_bad).run(pages)
    else:
        r = PaymentIngestion(lake, on_bad).run(pages)
        assert r == {"pages_fetched": 1, "payments_received": 2, "payments_inserted": 2, "refused_pages": 1}
    assert landed_places(lake) == {"copy-0": "p2", "copy-1": "p2"}


def test_first_copy_in_feed_order_decides(spark, lake):
    a, b, c = (dict(PAYMENT_RECORDS[0], payment_id=f"copy-{i}") for i in range(3))
    changed = dict(a, amount="7.00")
    r = PaymentIngestion(lake, "quarantine").run(feed_pages(spark, [a, b], [changed, c], [a, c, c]))
    assert r == {"pages_fetched": 2, "payments_received": 5, "payments_inserted": 3, "refused_pages": 1}
    # the page with the changed copy is refused whole; c lands from the next page that holds it
    assert landed_places(lake) == {"copy-0": "p2", "copy-1": "p2", "copy-2": "p18"}
    assert PaymentIngestion(lake, "quarantine").run(feed_pages(spark, [a, b], [a, c, c]))["payments_inserted"] == 0


def test_two_payment_runs_do_not_land_twice(spark, lake):
    a, b = (dict(PAYMENT_RECORDS[0], payment_id=f"copy-{i}") for i in range(2))
    plain, other = lake.stage, PaymentIngestion(type(lake)(spark, lake.root))

    def interleaved(table, df):
        lake.stage = plain
        other.run(feed_pages(spark, [a, b]))
        return plain(table, df)
    lake.stage = interleaved
    with pytest.raises(ConcurrentCommit, match="pipeline_already_running"):
        PaymentIngestion(lake).run(feed_pages(spark, [a, b]))
    assert landed_payments(lake).count() == 2


@pytest.mark.parametrize("cut", [1, 2])
def test_quarantine_does_not_depend_on_batch_borders(spark, lake, cut):
    versions = [CLICKS[0], dict(CLICKS[0], event_type="checkout"), CLICKS[0]]
    topic = tempfile.mkdtemp(prefix="topic-")
    ckpt = os.path.join(tempfile.mkdtemp(prefix="ckpt-"), "c")
    total = {}
    for first, part in ((0, versions[:cut]), (cut, versions[cut:])):
        st.publish(click_records(spark, part, first).coalesce(1), {"path": topic})
        for k, n in st.consume(spark, lake, {"path": topic}, ckpt, on_bad="quarantine").items():
            total[k] = total.get(k, 0) + n
    assert total == {"received": 3, "inserted": 1, "duplicates": 1, "quarantined": 1}
    assert [r["kafka_offset"] for r in st.landed_clicks(lake).collect()] == [0]


def test_a_drain_that_meets_another_classifies_again(spark, lake):
    topic1, topic2 = tempfile.mkdtemp(prefix="topic-"), tempfile.mkdtemp(prefix="topic-")
    for topic in (topic1, topic2):
        st.publish(click_records(spark, CLICKS), {"path": topic})
    plain, other = lake.stage, type(lake)(spark, lake.root)

    def interleaved(table, df):
        lake.stage = plain
        st.consume(spark, other, {"path": topic2}, os.path.join(tempfile.mkdtemp(), "c"))
        return plain(table, df)
    lake.stage = interleaved
    sink = st.ClickSink(lake, stream_id="by-hand")
    sink(spark.read.schema(st.KAFKA_COLUMNS).json(topic1), 0)
    assert st.landed_clicks(lake).count() == len(CLICKS)
    assert (sink.counters["inserted"], sink.counters["duplicates"]) == (0, len(CLICKS))


def test_commit_files_appear_whole_or_not_at_all(spark, lake):
    folder = f"{lake.root}/_commits"
    lake.commit({}, info={"event": "one"})
    # a writer that died before its file was published
    lake.fs.write_text(f"{folder}/.{2:020d}.json.dead", "")
    assert [c.number for c in lake.commits()] == [1] and lake.last_commit() == 1
    assert not lake.fs.create_new(f"{folder}/{1:020d}.json", "{}")
    assert lake.commits()[0].meta["info"] == {"event": "one"}
    assert lake.commit({}, info={"event": "two"}) == 2


def test_versions_that_differ_inside_a_batch_reach_the_ledger(spark, lake):
    twice = ORDERS + [ORDERS[0][:3] + (Decimal("1.00"),) + ORDERS[0][4:]]
    with pytest.raises(ValueError, match="order_version_payload_conflict"):
        OrderIngestion(lake, source(spark, twice)).run(CUTOFF)
    ledger = lake.read("order_conflicts", schemas.ORDER_CONFLICTS).collect()
    assert [(r["order_id"], r["existing_payload_hash"]) for r in ledger] == [(ORDERS[0][0], None)]
    assert landed_orders(lake).count() == 0
    with pytest.raises(ValueError, match="twice in the batch"):
        OrderIngestion(lake, source(spark, ORDERS + ORDERS[:1])).run(CUTOFF)


def test_feed_walk_with_a_gap_or_a_way_back(spark, lake):
    def feed_of(*links):
        return spark.createDataFrame([(f"p{i}", i, json.dumps({"data": [], "next_cursor": c}))
                                      for i, c in links], "page_id string, page_seq bigint, page string")
    with pytest.raises(ValueError, match="missing_page"):
        PaymentIngestion(lake).run(feed_of((0, "p1"), (1, "p2"), (3, None)))
    with pytest.raises(ValueError, match="repeated_cursor"):
        PaymentIngestion(lake).run(feed_of((0, "p1"), (1, "p2"), (2, "p1")))
    # pages that no cursor leads to are no part of the walk, whatever their own cursors say
    r = PaymentIngestion(lake).run(feed_of((0, "p1"), (1, None), (5, None), (6, "p7"), (7, "p6"), (8, "p9")))
    assert (r["pages_fetched"], r["detached_pages"]) == (2, 4)
    assert landed_payments(lake).count() == 0



def _wide_rows_shuffled(spark, action, monkeypatch):
    """Fields named payload below an exchange of the plans that ``action`` writes."""
    from pyspark.sql.readwriter import DataFrameWriter
    found, real = [], DataFrameWriter.parquet

    def noted(self, path, *a, **k):
        text = self._df._jdf.queryExecution().optimizedPlan().toString()
        found.extend(line for line in text.splitlines() if "Aggregate [" in line and "payload#" in line)
        return real(self, path, *a, **k)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    action()
    monkeypatch.undo()
    return found


def test_payloads_are_written_once_and_not_grouped(spark, lake, monkeypatch):
    """New orders land as staged, and classification groups keys and hashes without the payload."""
    ing = OrderIngestion(lake, source(spark))
    assert _wide_rows_shuffled(spark, lambda: ing.run(CUTOFF), monkeypatch) == []
    holders = [d for t in ("tables/raw_order_versions", "staging") for d in os.listdir(f"{lake.root}/{t}")
               if "payload" in spark.read.parquet(f"{lake.root}/{t}/{d}").columns]
    assert len(holders) == 1


def test_new_rows_among_landed_ones(spark, lake):
    """Few new among many, many new among few: each list of keys is the shorter one once."""
    OrderIngestion(lake, source(spark, ORDERS[:2])).run(CUTOFF)
    r = OrderIngestion(lake, source(spark)).backfill(datetime(2026, 1, 1, tzinfo=timezone.utc), CUTOFF)
    assert (r["inserted"], r["duplicates"]) == (6, 2)
    more = [*ORDERS, ("ord-9", *ORDERS[0][1:])]
    r = OrderIngestion(lake, source(spark, more)).backfill(datetime(2026, 1, 1, tzinfo=timezone.utc), CUTOFF)
    assert (r["inserted"], r["duplicates"]) == (1, 8) and landed_orders(lake).distinct().count() == 9


def test_replayed_payments_write_no_payload_to_land(spark, lake):
    a, b, c = (dict(PAYMENT_RECORDS[0], payment_id=f"copy-{i}") for i in range(3))
    PaymentIngestion(lake).run(feed_pages(spark, [a, b]))
    tables = f"{lake.root}/tables/raw_payment_versions"
    before = len(os.listdir(tables))
    r = PaymentIngestion(lake).run(feed_pages(spark, [a, b]))
    assert r["payments_inserted"] == 0 and len(os.listdir(tables)) == before
    r = PaymentIngestion(lake).run(feed_pages(spark, [a, c, c], [b]))
    assert (r["payments_received"], r["payments_inserted"]) == (4, 1) and landed_payments(lake).count() == 3


def test_packed_hashes_keep_texts_apart(spark):
    from tidemark.functions.canonical import packed_hash, unpacked_hash
    texts = ["a" * 64, "A" * 64, "ab" * 16, "", "\x01", "ab", "é" * 32, "a" * 64 + "\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed_hash(F.col("t")).alias("p"))
    rows = df.select("t", "p", unpacked_hash(F.col("p")).alias("u")).collect()
    assert all(r["t"] == r["u"] for r in rows) and len({bytes(r["p"]) for r in rows if r["p"] is not None}) == 8
    assert len(rows[0]["p"]) == 33 and len(rows[2]["p"]) == 17
