"""Incremental, idempotent, conflict-detecting ingestion.

Orders: each run scans one half-open window of the source (S1), renders the
canonical payload and hash (P1, P2), classifies every (order_id, version)
against the index of landed keys in one join (J4; ``sources/keyindex.py``).  The window is staged as rows of the
table, and the labels of its keys, without payloads, are written beside it; a window of new rows is published as staged.  Counters come from one
small aggregate over the written labels.  Then exactly one commit publishes either

* the new rows, the succeeded run row and (for scheduled runs) the checkpoint,
* or, on a same-version/different-payload conflict, the conflict ledger rows
  and the failed run row -- and the run raises ``order_version_payload_conflict``.

Because the classified batch is a written table, a lost executor only
re-runs its own tasks and nothing is recomputed from the source twice.
Payments (I7) land whole pages or nothing; every copy of a payment keeps its
own page, and the first copy in feed order decides.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.canonical import canonical_json, packed_hash, payload_hash, unpacked_hash
from ..functions.contracts import check_payments
from ..operators.versions import CONFLICT, DUPLICATE, NEW, classify, classify_copies, latest_by
from ..sources import feed
from ..sources.keyindex import KeyIndex
from ..sources.lake import Lake
from ..sources.scan import SOURCE_COLUMNS, Window, change_scan

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
DEFAULT_INITIAL_START = datetime(2026, 1, 1, tzinfo=timezone.utc)
DEFAULT_LOOKBACK = timedelta(minutes=15)
CONFLICT_REASON = "same_version_different_payload"
INVALID = "invalid"
KEY = ["order_id", "version"]
LEDGER_COUNTS = {"extracted": "extracted_count", "inserted": "inserted_count",
                 "duplicates": "duplicate_count", "conflicts": "conflict_count"}


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class Run:
    """One pass over a window; ``scheduled`` runs move the checkpoint."""
    pipeline: str
    window: Window
    scheduled: bool
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    started: datetime = field(default_factory=_now)

    def ledger(self, spark, status: str, error: str | None = None, **counts) -> DataFrame:
        """The run's next ledger row: seq 1 when it starts, 2 when it ends."""
        ended = status != "running"
        known = {"run_id": self.run_id, "pipeline_name": self.pipeline, "window_start": self.window.start,
                 "window_end": self.window.end, "status": status, "started_at": self.started,
                 "completed_at": _now() if ended else None, "error_code": error, "seq": 2 if ended else 1, **counts}
        row = tuple(known.get(c) for c in schemas.INGESTION_RUNS.fieldNames())
        return spark.createDataFrame([row], schemas.INGESTION_RUNS)


class OrderIngestion:
    """Lands the order versions of a change window (module docstring)."""

    def __init__(self, lake: Lake, source: DataFrame, *, pipeline_name: str = "orders_incremental",
                 initial_start: datetime = DEFAULT_INITIAL_START, lookback: timedelta = DEFAULT_LOOKBACK):
        if lookback < timedelta(0) or initial_start.utcoffset() is None:
            raise ValueError("the lookback is negative or the first window has no UTC offset")
        self.lake, self.spark, self.source = lake, lake.spark, source
        self.index = KeyIndex(lake, "raw_order_versions", schemas.RAW_ORDER_VERSIONS, ("order_id", "version"))
        self.pipeline, self.initial_start, self.lookback = pipeline_name, initial_start, lookback

    def checkpoint(self) -> datetime | None:
        """The furthest published window end: it never moves back, so no clock is compared."""
        cps = self.lake.read("checkpoints", schemas.CHECKPOINTS).where(F.col("pipeline_name") == self.pipeline)
        micros = cps.agg(F.unix_micros(F.max("last_completed_window_end"))).first()[0]
        return None if micros is None else EPOCH + timedelta(microseconds=micros)

    def run(self, safe_cutoff: datetime) -> dict:
        """From the checkpoint, less the lookback, to ``safe_cutoff``."""
        done, start = self.checkpoint(), self.initial_start
        if done is not None:
            if Window(safe_cutoff, safe_cutoff).end < done:
                raise ValueError("the cutoff lies before the checkpoint; that is a backfill")
            start = max(start, done - self.lookback)
        return self._execute(Run(self.pipeline, Window(start, safe_cutoff), scheduled=True))

    def backfill(self, start: datetime, end: datetime) -> dict:
        """An explicit window; the checkpoint is untouched."""
        return self._execute(Run(self.pipeline, Window(start, end), scheduled=False))

    def _execute(self, run: Run) -> dict:
        opened = self.lake.append({"ingestion_runs": run.ledger(self.spark, "running")},
                                  info={"run_id": run.run_id, "event": "start"})
        found: dict = {}
        try:
            folder, labelled, found = self._classified(run)
            if found["nulls"]:
                raise ValueError("order metadata is NULL")
            if not found["conflicts"]:
                if found["copies"] > 1:
                    raise ValueError("an order version occurs twice in the batch")
                return self._publish(run, opened, folder, labelled, found)
        except Exception as exc:
            self._fail(run, exc, found)
            raise
        self._refuse(run, folder, labelled, found)
        raise ValueError("order_version_payload_conflict")

    def _classified(self, run: Run) -> tuple[str, DataFrame, dict]:
        """Stage the window, write the labels of its keys; return the folder, the labels and their counts."""
        rows = change_scan(self.source, run.window).select(*SOURCE_COLUMNS)
        rows = rows.select("order_id", "version", F.col("updated_at").alias("source_updated_at"),
                           canonical_json(rows, list(SOURCE_COLUMNS)).alias("payload"))
        # the staged window is a written table: the source is scanned once
        token = self.lake.stage("raw_order_versions", rows.select(
            "*", payload_hash(F.col("payload")).alias("payload_hash"), F.current_timestamp().alias("ingested_at"),
            F.lit(run.run_id).alias("first_seen_run_id")))
        staged = self._staged(token)
        # keys and hashes are classified; a payload is never shuffled for it
        narrow, landed = (df.withColumn("payload_hash", packed_hash(F.col("payload_hash"))) for df in (
            staged.select(*KEY, "source_updated_at", "payload_hash"), self.index.landed(staged)))
        differs = F.col("status") == CONFLICT
        labelled, _ = self.lake.scratch(classify(narrow, landed, KEY).select(
            *KEY, "source_updated_at", F.when(differs, unpacked_hash(F.col("payload_hash"))).alias("payload_hash"),
            F.when(differs, unpacked_hash(F.col("existing_hash"))).alias("existing_hash"), "batch_copies", "status"),
            f"orders-labelled-{run.run_id}")
        null = F.col("order_id").isNull() | F.col("version").isNull() | F.col("source_updated_at").isNull()
        found = labelled.agg(
            F.coalesce(F.sum("batch_copies"), F.lit(0)).alias("extracted"),
            F.count_if(F.col("status") == NEW).alias("new"),
            F.count_if(F.col("status") == CONFLICT).alias("conflicts"),
            F.coalesce(F.max("batch_copies"), F.lit(0)).alias("copies"),
            F.count_if(null).alias("nulls")).first().asDict()
        return token, labelled, found

    def _staged(self, token: str) -> DataFrame:
        return self.spark.read.schema(schemas.RAW_ORDER_VERSIONS).parquet(f"{self.lake.root}/tables/raw_order_versions/{token}")

    def _new_rows(self, token: str, labelled: DataFrame, found: dict) -> str:
        """The folder of the new rows: the staged one if all are new, else a copy without the others.  Every key
        occurs once here; of the lists of new and other keys the shorter one is joined."""
        others = found["extracted"] - found["new"]
        if not others:
            return token
        status, how = (NEW, "left_semi") if found["new"] <= others else (DUPLICATE, "left_anti")
        listed, _ = self.lake.scratch(labelled.where(F.col("status") == status).select(*KEY), f"orders-{status}")
        return self.lake.stage("raw_order_versions", self._staged(token).join(listed, KEY, how))

    def _publish(self, run: Run, opened: int, folder: str, labelled: DataFrame, found: dict) -> dict:
        """One commit: rows, run and checkpoint; refused if another run published since ``opened``."""
        counts = {"extracted": found["extracted"], "inserted": found["new"],
                  "duplicates": found["extracted"] - found["new"], "conflicts": 0}
        staged = {"ingestion_runs": [self.lake.stage("ingestion_runs", run.ledger(
            self.spark, "succeeded", **{LEDGER_COUNTS[k]: n for k, n in counts.items()}))]}
        if found["new"]:
            landing = self._new_rows(folder, labelled, found)
            staged["raw_order_versions"] = [landing]
            staged[self.index.entry] = [self.index.stage(self._staged(landing))]
        if run.scheduled:
            moved = self.spark.createDataFrame([(run.pipeline, run.window.end, run.run_id, _now())],
                                               schemas.CHECKPOINTS)
            staged["checkpoints"] = [self.lake.stage("checkpoints", moved)]
        self.lake.commit(staged, info={"run_id": run.run_id, "event": "succeeded"},
                         guard=("raw_order_versions", "checkpoints"), since=opened)
        return {"run_id": run.run_id, **counts, "checkpoint_advanced": run.scheduled}

    def _refuse(self, run: Run, folder: str, labelled: DataFrame, found: dict) -> None:
        """The ledger keeps metadata only (two hashes), never the payload.
        Copies that differ inside the batch have no stored hash (NULL)."""
        rows = labelled.where(F.col("status") == CONFLICT)
        if found["copies"] > 1:   # of copies that differ the first by time and payload is named
            several = rows.where("batch_copies > 1").select(*KEY)
            named = self._staged(folder).join(several, KEY, "left_semi").groupBy(*KEY).agg(
                F.min(F.struct("source_updated_at", "payload", "payload_hash")).alias("_row"))
            rows = rows.join(named, KEY, "left").withColumn("payload_hash", F.coalesce("_row.payload_hash", "payload_hash"))
        rows = rows.select(
            F.expr("uuid()").alias("conflict_id"), F.lit(run.run_id).alias("run_id"), "order_id", "version",
            F.col("existing_hash").alias("existing_payload_hash"),
            F.col("payload_hash").alias("incoming_payload_hash"),
            F.lit(CONFLICT_REASON).alias("reason_code"), F.current_timestamp().alias("detected_at"))
        failed = run.ledger(self.spark, "failed", "ValueError", **{
            LEDGER_COUNTS["extracted"]: found["extracted"], LEDGER_COUNTS["conflicts"]: found["conflicts"]})
        self.lake.append({"order_conflicts": rows, "ingestion_runs": failed},
                         info={"run_id": run.run_id, "event": "conflict"})

    def _fail(self, run: Run, exc: Exception, found: dict) -> None:
        """Ledger the failure; the first error is the one to report, so a second is only noted on it."""
        try:
            self.lake.append({"ingestion_runs": run.ledger(self.spark, "failed", type(exc).__name__, **{
                LEDGER_COUNTS["extracted"]: found.get("extracted", 0)})}, info={"run_id": run.run_id, "event": "failed"})
        except Exception as second:
            exc.add_note(f"the run's failure could not be ledgered: {second}")


def latest_runs(lake: Lake, commits=None) -> DataFrame:
    """Current state of every run (the row with the highest ``seq``)."""
    runs = lake.read("ingestion_runs", schemas.INGESTION_RUNS, commits=commits)
    cols = [c for c in runs.columns if c != "run_id"]
    return runs.groupBy("run_id").agg(F.max_by(F.struct(*cols), "seq").alias("r")).select("run_id", "r.*")


def landed_orders(lake: Lake) -> DataFrame:
    return lake.read("raw_order_versions", schemas.RAW_ORDER_VERSIONS)


# ------------------------------------------------------------------ payments
class PaymentIngestion:
    """Landed feed pages -> raw payment versions, page-atomic.

    A page with an invalid record is refused.  On the pages without one, a
    payment's stored hash decides, or else its first copy in feed order (page
    number, place in the page); a page with a copy that differs is refused too,
    whether or not the page of the first copy lands.  A payment lands once, from
    its first copy on a page that lands.

    ``on_bad="fail"``: the first refused page stops the run; the pages before it
    land, and the named error is raised.  ``on_bad="quarantine"``: every page
    that is not refused lands; the number of refused ones is in the result.

    Only pages on the walk from the first page take part; the number of others is in the result.

    A run that finds other payments published since it started raises
    ``pipeline_already_running`` and lands nothing.
    """

    def __init__(self, lake: Lake, on_bad: str = "fail"):
        if on_bad not in ("fail", "quarantine"):
            raise ValueError("on_bad must be fail or quarantine")
        self.lake, self.on_bad, self.spark = lake, on_bad, lake.spark
        self.index = KeyIndex(lake, "raw_payment_versions", schemas.RAW_PAYMENT_VERSIONS, ("payment_id", "version"))

    def run(self, pages: DataFrame) -> dict:
        since = self.lake.last_commit()
        pages, _ = self.lake.scratch(pages.select("page_id", "page_seq", "page"), "payment-pages")
        parsed = feed.parse_pages(pages, carried=("page_seq",))
        parsed, walked = feed.check_pages(parsed)
        pages = self.lake.scratch(parsed.select("page_id", "page_seq"), "payment-walk")[0]
        recs = check_payments(feed.explode_records(parsed), "payload")
        v = F.try_parse_json(F.col("payload"))
        recs = recs.select("page_id", "page_seq", "pos", "payload",
                           F.try_variant_get(v, "$.payment_id", "string").alias("payment_id"),
                           F.try_variant_get(v, "$.version", "bigint").alias("version"),
                           F.try_variant_get(v, "$.order_id", "string").alias("order_id"),
                           (F.size("invalid_fields") > 0).alias("bad"))
        recs, _ = self.lake.scratch(recs, "payments")
        keys = ["payment_id", "version"]
        # lists of pages are written, so that their size is known where records are joined to them
        invalid_pages, _ = self.lake.scratch(recs.where("bad").select("page_id").distinct(), "payments-invalid")
        hashed = F.col("payload_hash")
        sound = recs.drop("bad").join(invalid_pages, on="page_id", how="left_anti")
        # places, keys and hashes are classified; a payload is never shuffled for it
        narrow = sound.select("page_id", "page_seq", "pos", *keys, packed_hash(payload_hash(F.col("payload"))).alias("payload_hash"))
        landed = self.index.landed(sound).withColumn("payload_hash", packed_hash(hashed))
        labelled, _ = self.lake.scratch(
            classify_copies(narrow, landed, keys, ("page_seq", "pos")).drop("payload_hash"), "payments-labelled")
        # one row per page, pages without records included
        refused = labelled.where(F.col("status") == CONFLICT).select("page_id", F.lit(CONFLICT).alias("why")) \
            .unionByName(invalid_pages.select("page_id", F.lit(INVALID).alias("why"))) \
            .groupBy("page_id").agg(F.max("why").alias("why"))
        judged, _ = self.lake.scratch(pages.select("page_id", "page_seq").join(refused, on="page_id", how="left"), "payments-judged")
        summary = judged.agg(F.min(F.when(F.col("why").isNotNull(), F.col("page_seq"))).alias("stop"),
                             F.min_by("why", F.when(F.col("why").isNotNull(), F.col("page_seq"))).alias("why"),
                             F.count("why").alias("refused")).first()
        stop = summary["stop"]
        keep = judged.where(F.col("why").isNull())
        if self.on_bad == "fail" and stop is not None:
            keep = keep.where(F.col("page_seq") < stop)
        kept_pages, _ = self.lake.scratch(keep.select("page_id"), "payments-kept")
        kept = labelled.join(kept_pages, on="page_id", how="left_semi")
        fresh = kept.where(~F.col("stored"))
        received = kept.count()
        told = fresh.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).agg(
            F.count(F.lit(1)).alias("payments"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first()
        inserted = told["payments"]
        published = {}
        if inserted:
            new_rows = recs.join(kept_pages, on="page_id", how="left_semi")
            if inserted == told["rows"] == received:   # every payment of these pages lands
                new_rows = new_rows.dropna(subset=keys)
            else:
                place = ["page_id", "page_seq", "pos", *keys]
                new_rows = latest_by(new_rows.join(fresh.select(*place), on=place, how="left_semi"), keys,
                                     ("page_seq", "pos"), descending=False)
            staged = self.lake.stage("raw_payment_versions", new_rows.select(
                *keys, "order_id", "payload", payload_hash(F.col("payload")).alias("payload_hash"),
                F.current_timestamp().alias("ingested_at"), "page_id"))
            landing = self.spark.read.schema(schemas.RAW_PAYMENT_VERSIONS).parquet(
                f"{self.lake.root}/tables/raw_payment_versions/{staged}")
            published = {"raw_payment_versions": [staged], self.index.entry: [self.index.stage(landing)]}
        self.lake.commit(published, info={"event": "payments"},
                         guard=("raw_payment_versions",), since=since)
        result = {"pages_fetched": keep.count(), "payments_received": received,
                  "payments_inserted": int(inserted)}
        if walked["detached"]:
            result["detached_pages"] = walked["detached"]
        if stop is not None:
            if self.on_bad == "fail":
                raise ValueError("invalid_payment_contract" if summary["why"] == INVALID
                                 else "payment_version_payload_conflict")
            result["refused_pages"] = int(summary["refused"])
        return result


def landed_payments(lake: Lake) -> DataFrame:
    return lake.read("raw_payment_versions", schemas.RAW_PAYMENT_VERSIONS)


def save_quality(lake: Lake, results: dict, passed: bool) -> None:
    """Q6 ledger row: written before any blocking failure is raised."""
    spark = lake.spark
    row = spark.createDataFrame([(uuid.uuid4().hex, _now(), json.dumps(results, sort_keys=True), passed)],
                                schemas.QUALITY_RUNS)
    lake.append({"quality_runs": row}, info={"event": "quality"})
