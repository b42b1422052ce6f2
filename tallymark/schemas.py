"""Declared schemas of every layer and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values -------------------------------------------------------------

CHANNELS = ("card", "bank_transfer", "ussd", "qr")
STATUSES = ("pending", "success", "failed", "reversed")
TERMINAL_STATUSES = ("success", "failed", "reversed")
STATUS_RANK = {"pending": 0, "failed": 1, "success": 2, "reversed": 3}
FAILURE_REASONS = (
    "insufficient_funds",
    "do_not_honour",
    "invalid_pin",
    "timeout",
    "limit_exceeded",
    "suspected_fraud",
)
CURRENCIES = ("NGN", "USD")
SETTLEMENT_LAGS = (1, 2)
RECONCILIATION_STATUSES = (
    "matched",
    "missing_settlement",
    "partial_settlement",
    "short_paid",
    "overpaid",
    "reversed_after_settlement",
    "unverified_source",
)
RECONCILIATION_BUCKETS = (
    "settled",
    "pending_t1",
    "pending_t2",
    "pending_within_sla",
    "breached_sla",
)
FRESHNESS = ("fresh", "stale_or_incomplete")
BREAK_TYPES = (
    "missing_settlement",
    "partial_settlement",
    "short_paid",
    "overpaid",
    "reversed_after_settlement",
)
SYSTEM_STATUSES = ("OPEN", "CLEARED")
ANALYST_STATUSES = ("MANUAL_REVIEW", "ESCALATED", "EXPECTED_DELAY", "CLOSED")
ACTIONS = ("START_REVIEW", "ESCALATE", "MARK_EXPECTED_DELAY", "CLOSE", "REOPEN")
NOTE_REQUIRED = ("ESCALATE", "CLOSE", "REOPEN")
FACT_ASSERTING = ("CLOSED", "EXPECTED_DELAY")
QUEUE_VIEWS = ("active", "closed", "cleared", "all")

UNTOUCHED = "UNTOUCHED"  # no analyst status yet; stored as null
TRANSITIONS = (
    ("UNTOUCHED", "START_REVIEW", "MANUAL_REVIEW"),
    ("UNTOUCHED", "ESCALATE", "ESCALATED"),
    ("UNTOUCHED", "MARK_EXPECTED_DELAY", "EXPECTED_DELAY"),
    ("UNTOUCHED", "CLOSE", "CLOSED"),
    ("MANUAL_REVIEW", "ESCALATE", "ESCALATED"),
    ("MANUAL_REVIEW", "MARK_EXPECTED_DELAY", "EXPECTED_DELAY"),
    ("MANUAL_REVIEW", "CLOSE", "CLOSED"),
    ("ESCALATED", "CLOSE", "CLOSED"),
    ("EXPECTED_DELAY", "START_REVIEW", "MANUAL_REVIEW"),
    ("EXPECTED_DELAY", "ESCALATE", "ESCALATED"),
    ("EXPECTED_DELAY", "CLOSE", "CLOSED"),
    ("CLOSED", "REOPEN", "UNTOUCHED"),
)

QUARANTINE_MAX_BYTES = 256_000

# --- Schemas ------------------------------------------------------------------


def _struct(*fields: tuple) -> StructType:
    """Fields as (name, type) when required, (name, type, True) when nullable."""
    return StructType([StructField(f[0], f[1], len(f) > 2) for f in fields])


_S, _L, _I, _D, _T, _B = (
    StringType(),
    LongType(),
    IntegerType(),
    DateType(),
    TimestampType(),
    BooleanType(),
)

TRANSACTION_EVENT = _struct(
    ("event_id", _S),
    ("event_ts", _T),
    ("transaction_ref", _S),
    ("merchant_id", _S),
    ("customer_id", _S),
    ("gateway", _S),
    ("channel", _S),
    ("bank_code", _S, True),
    ("status", _S),
    ("amount_kobo", _L),  # money is whole kobo, never a float
    ("fee_kobo", _L),
    ("currency", _S),
    ("fx_rate_to_ngn", DoubleType(), True),
    ("failure_reason", _S, True),
    ("settlement_lag_days", _I),
    ("settlement_source_watermark_at", _T),
    ("created_at", _T),
    ("updated_at", _T),
    ("ingested_at", _T),
)

SETTLEMENT_EVENT = _struct(
    ("event_id", _S),
    ("event_ts", _T),
    ("settlement_id", _S),
    ("payout_id", _S),
    ("merchant_id", _S),
    ("transaction_ref", _S),
    ("gross_kobo", _L),
    ("fee_kobo", _L),
    ("net_kobo", _L),
    ("currency", _S),
    ("settlement_date", _D),
    ("settled_at", _T),
    ("ingested_at", _T),
)

QUARANTINE = _struct(
    ("source_topic", _S),
    ("ingested_at", _T),
    ("error_type", _S),
    ("raw_payload", _S),
    ("payload_truncated", _B),
)

# What the raw-to-staged step adds to an event row.
STAGED_TRANSACTION = StructType(
    [StructField(f.name, f.dataType, True) for f in TRANSACTION_EVENT]
    + [
        StructField("successful_at", _T),
        StructField("amount_ngn_kobo", _L),
        StructField("fee_ngn_kobo", _L),
        StructField("arrival_lag_seconds", _L),
        StructField("is_terminal", _B),
        StructField("expected_settlement_date", _D),
        StructField("processed_at", _T),
        StructField("event_date", _D),
    ]
)

STAGED_SETTLEMENT = StructType(
    [StructField(f.name, f.dataType, True) for f in SETTLEMENT_EVENT]
    + [StructField("processed_at", _T)]
)

BREAK = _struct(
    ("case_id", _S),
    ("transaction_ref", _S),
    ("merchant_id", _S),
    ("channel", _S),
    ("gateway", _S),
    ("bank_code", _S, True),
    ("currency", _S),
    ("succeeded_date", _D),
    ("amount_ngn_kobo", _L),
    ("expected_net_kobo", _L),
    ("settled_net_kobo", _L, True),
    ("break_type", _S),
    ("exposure_kobo", _L),
)

CASE = _struct(
    ("case_id", _S),
    ("display_id", _S),
    ("transaction_ref", _S),
    ("merchant_id", _S),
    ("channel", _S),
    ("gateway", _S),
    ("bank_code", _S, True),
    ("currency", _S),
    ("succeeded_date", _D),
    ("amount_ngn_kobo", _L),
    ("expected_net_kobo", _L),
    ("settled_net_kobo", _L, True),
    ("break_type", _S),
    ("exposure_kobo", _L),
    ("system_status", _S),
    ("system_fingerprint", _S),
    ("analyst_status", _S, True),
    ("decided_fingerprint", _S, True),
    ("first_seen_at", _T),
    ("last_seen_at", _T),
    ("updated_at", _T),
)

ACTION_REQUEST = _struct(
    ("action_id", _L),  # position in the log: unique and increasing
    ("case_id", _S),
    ("analyst", _S, True),
    ("action", _S),
    ("notes", _S, True),
    ("idempotency_key", _S),
    ("created_at", _T),
)

CASE_ACTION = _struct(
    ("action_id", _L),
    ("case_id", _S),
    ("analyst", _S),
    ("action", _S),
    ("notes", _S),
    ("idempotency_key", _S),
    ("resulting_status", _S, True),
    ("fingerprint_at_action", _S),
    ("created_at", _T),
)

PUBLISH_LEDGER = _struct(
    ("run_key", _S),
    ("chunk_start", _L),
    ("transactions", _L),
    ("settlements", _L),
    ("committed_at", _T),
)


def nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema])
