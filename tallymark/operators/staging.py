"""Raw events to staged rows: redeliveries out, one row per key, derived columns on.

Both reductions are mergeable aggregates (min and max of a struct) rather than window
functions. Each map task sends at most one row per key, so a key that owns a third of
the input, by redelivery or by a long status history, never lands whole on one task.
The first aggregate keys on (ref, event), which also spreads one ref over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import status_rank, to_ngn_kobo
from tallymark.schemas import TERMINAL_STATUSES

TRANSACTION_KEY = ("transaction_ref", "event_id")
SETTLEMENT_KEY = ("settlement_id", "transaction_ref")
FIRST_DELIVERY = ("ingested_at", "event_ts")


def first_delivery(events: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keep the earliest delivery per key. The remaining columns break ties, so the
    survivor does not depend on the order of files or tasks."""
    rest = [c for c in events.columns if c not in keys and c not in FIRST_DELIVERY]
    return (
        events.groupBy(*keys)
        .agg(F.min(F.struct(*FIRST_DELIVERY, *rest)).alias("_first"))
        .select(*keys, "_first.*")
        .select(*events.columns)
    )


def dedupe_transactions(raw: DataFrame) -> DataFrame:
    return first_delivery(raw, TRANSACTION_KEY)


def dedupe_settlements(raw: DataFrame) -> DataFrame:
    return first_delivery(raw, SETTLEMENT_KEY)


def latest_status(events: DataFrame) -> DataFrame:
    """One row per transaction: the event that is last by event time, not by arrival.

    Order is updated_at, then status rank, then event_id. `successful_at` is the last
    success the transaction ever had, whatever its status is now.
    """
    order = ["updated_at", "status_rank", "event_id"]
    ranked = events.withColumn("status_rank", status_rank(F.col("status")))
    rest = [c for c in events.columns if c not in order and c != "transaction_ref"]
    return (
        ranked.groupBy("transaction_ref")
        .agg(
            F.max(F.struct(*order, *rest)).alias("_last"),
            F.max(F.when(F.col("status") == "success", F.col("updated_at"))).alias("successful_at"),
        )
        .select("transaction_ref", "_last.*", "successful_at")
        .select(*events.columns, "successful_at")
    )


def derive(latest: DataFrame) -> DataFrame:
    """Columns every mart needs, computed once."""
    fx, currency = F.col("fx_rate_to_ngn"), F.col("currency")
    succeeded = F.coalesce(F.col("successful_at"), F.col("updated_at"))
    return latest.withColumns(
        {
            "amount_ngn_kobo": to_ngn_kobo(F.col("amount_kobo"), currency, fx),
            "fee_ngn_kobo": to_ngn_kobo(F.col("fee_kobo"), currency, fx),
            "arrival_lag_seconds": F.unix_timestamp("ingested_at") - F.unix_timestamp("updated_at"),
            "is_terminal": F.col("status").isin(*TERMINAL_STATUSES),
            "expected_settlement_date": F.date_add(
                F.to_date(succeeded), F.col("settlement_lag_days")
            ),
            "event_date": F.to_date("created_at"),
        }
    )


def stage_transactions(raw: DataFrame, processed_at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if processed_at is None else processed_at.cast("timestamp")
    return derive(latest_status(dedupe_transactions(raw))).withColumn("processed_at", stamp)


def stage_settlements(raw: DataFrame, processed_at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if processed_at is None else processed_at.cast("timestamp")
    return dedupe_settlements(raw).withColumn("processed_at", stamp)


def transaction_metrics(raw: DataFrame) -> DataFrame:
    """Row counts before and after each reduction, from one pair of narrow aggregates."""
    per_event = raw.groupBy(*TRANSACTION_KEY).agg(F.count("*").alias("copies"))
    per_ref = per_event.groupBy("transaction_ref").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("events")
    )
    total = per_ref.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_events"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("after_dedupe"),
        F.count("*").alias("transactions_out"),
    )
    return total.select(
        "raw_events",
        "after_dedupe",
        (F.col("raw_events") - F.col("after_dedupe")).alias("duplicates_removed"),
        "transactions_out",
        (F.col("after_dedupe") - F.col("transactions_out")).alias("events_collapsed"),
    )


def settlement_metrics(raw: DataFrame) -> DataFrame:
    per_line = raw.groupBy(*SETTLEMENT_KEY).agg(F.count("*").alias("copies"))
    total = per_line.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("raw_events"),
        F.count("*").alias("settlements_out"),
    )
    return total.withColumn("duplicates_removed", F.col("raw_events") - F.col("settlements_out"))


# --- Typed views over staged files -------------------------------------------------

STG_TRANSACTION_CASTS = {
    "amount_kobo": "bigint",
    "fee_kobo": "bigint",
    "amount_ngn_kobo": "bigint",
    "fee_ngn_kobo": "bigint",
    "fx_rate_to_ngn": "double",
    "created_at": "timestamp",
    "updated_at": "timestamp",
    "successful_at": "timestamp",
    "ingested_at": "timestamp",
    "event_date": "date",
    "arrival_lag_seconds": "bigint",
    "settlement_lag_days": "int",
    "expected_settlement_date": "date",
    "settlement_source_watermark_at": "timestamp",
}


def stg_transactions(staged: DataFrame) -> DataFrame:
    """27 typed columns. Eligibility for settlement is defined here and nowhere else."""
    plain = [
        "transaction_ref",
        "merchant_id",
        "customer_id",
        "gateway",
        "channel",
        "bank_code",
        "status",
        "currency",
        "failure_reason",
    ]
    status = F.col("status")
    return staged.select(
        *plain,
        *[F.col(c).cast(t).alias(c) for c, t in STG_TRANSACTION_CASTS.items()],
        "is_terminal",
        (status == "success").alias("is_success"),
        (status == "reversed").alias("is_reversed"),
        (status == "success").alias("is_settlement_eligible"),
    )


def stg_settlements(staged: DataFrame) -> DataFrame:
    """11 typed columns."""
    return staged.select(
        "settlement_id",
        "payout_id",
        "transaction_ref",
        "merchant_id",
        F.col("gross_kobo").cast("bigint").alias("gross_kobo"),
        F.col("fee_kobo").cast("bigint").alias("fee_kobo"),
        F.col("net_kobo").cast("bigint").alias("net_kobo"),
        "currency",
        F.col("settlement_date").cast("date").alias("settlement_date"),
        F.col("settled_at").cast("timestamp").alias("settled_at"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
    )
