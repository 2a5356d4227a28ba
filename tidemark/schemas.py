"""Schemas of the landed and control tables, and their declared rules (V7).

Reads always pass these schemas; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

from .operators.checks import Constraint

_TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType(),
          "timestamp": TimestampType(), "boolean": BooleanType(), "double": DoubleType()}


def _schema(text: str) -> StructType:
    """'name type, ...' with simple types -> StructType (no session needed)."""
    fields = []
    for part in text.split(","):
        name, typ = part.split()
        fields.append(StructField(name, _TYPES[typ], True))
    return StructType(fields)


RAW_ORDER_VERSIONS = _schema(
    "order_id string, version bigint, source_updated_at timestamp, payload string, "
    "payload_hash string, ingested_at timestamp, first_seen_run_id string")
RAW_PAYMENT_VERSIONS = _schema(
    "payment_id string, version bigint, order_id string, payload string, payload_hash string, "
    "ingested_at timestamp, page_id string")
CLICKSTREAM_EVENTS = _schema(
    "event_id string, payload string, payload_hash string, topic string, kafka_partition int, "
    "kafka_offset bigint, ingested_at timestamp")
CLICK_QUARANTINE = _schema(
    "topic string, kafka_partition int, kafka_offset bigint, value string, reason string, "
    "ingested_at timestamp")
INGESTION_RUNS = _schema(
    "run_id string, pipeline_name string, window_start timestamp, window_end timestamp, "
    "status string, started_at timestamp, completed_at timestamp, extracted_count bigint, "
    "inserted_count bigint, duplicate_count bigint, conflict_count bigint, error_code string, "
    "seq bigint")
CHECKPOINTS = _schema(
    "pipeline_name string, last_completed_window_end timestamp, last_successful_run_id string, "
    "updated_at timestamp")
ORDER_CONFLICTS = _schema(
    "conflict_id string, run_id string, order_id string, version bigint, "
    "existing_payload_hash string, incoming_payload_hash string, reason_code string, "
    "detected_at timestamp")
QUALITY_RUNS = _schema(
    "run_id string, checked_at timestamp, results string, passed boolean")
METRIC_SAMPLES = _schema("metric string, ts timestamp, value double")

RUN_STATUSES = ("running", "succeeded", "failed")

# Declared rules of the landed tables (fixed values from the table definitions).
RULES = {
    "raw_order_versions": [
        Constraint("raw_order_pk", "unique", ("order_id", "version")),
        Constraint("raw_order_version_positive", "check", predicate="version >= 1"),
        Constraint("raw_order_hash_format", "check", predicate="payload_hash rlike '^[0-9a-f]{64}$'"),
        Constraint("raw_order_not_null", "not_null", ("order_id", "version", "payload", "payload_hash")),
    ],
    "raw_payment_versions": [
        Constraint("raw_payment_pk", "unique", ("payment_id", "version")),
    ],
    "clickstream_events": [
        Constraint("click_pk", "unique", ("event_id",)),
        Constraint("click_source_unique", "unique", ("topic", "kafka_partition", "kafka_offset")),
    ],
    "ingestion_runs": [
        Constraint("run_window_order", "check", predicate="window_start <= window_end"),
        Constraint("run_counts_not_negative", "check",
                   predicate="coalesce(extracted_count, 0) >= 0 and coalesce(inserted_count, 0) >= 0 "
                             "and coalesce(duplicate_count, 0) >= 0 and coalesce(conflict_count, 0) >= 0"),
        Constraint("run_status_known", "check", predicate="status in ('running', 'succeeded', 'failed')"),
        Constraint("run_completion_matches_status", "check",
                   predicate="(status = 'running') = (completed_at is null)"),
    ],
    "order_items": [
        Constraint("item_quantity_positive", "check", predicate="quantity > 0"),
        Constraint("item_price_not_negative", "check", predicate="unit_price >= 0"),
        Constraint("item_pk", "unique", ("order_id", "line_number")),
    ],
    "refunds": [Constraint("refund_amount_positive", "check", predicate="amount > 0")],
    "customer_history": [
        Constraint("history_range_order", "check", predicate="valid_to is null or valid_to > valid_from"),
        Constraint("history_pk", "unique", ("customer_id", "valid_from")),
    ],
}
