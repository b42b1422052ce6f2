"""Facts and the two activity marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions import rate, round_to
from tallymark.schemas import FAILURE_REASONS
from tallymark.sources.by_reference import KEY, ByReference


def fct_transactions(stg_tx: DataFrame) -> DataFrame:
    """One row per transaction_ref."""
    return stg_tx.select(
        "transaction_ref",
        "merchant_id",
        "customer_id",
        "gateway",
        "channel",
        "bank_code",
        "status",
        "currency",
        "failure_reason",
        "amount_kobo",
        "fee_kobo",
        "amount_ngn_kobo",
        "fee_ngn_kobo",
        (F.col("amount_ngn_kobo") - F.col("fee_ngn_kobo")).alias("net_ngn_kobo"),
        "fx_rate_to_ngn",
        "created_at",
        "updated_at",
        "successful_at",
        "ingested_at",
        "event_date",
        "arrival_lag_seconds",
        "settlement_lag_days",
        "expected_settlement_date",
        "settlement_source_watermark_at",
        "is_success",
        "is_reversed",
        "is_settlement_eligible",
    )


def fct_settlements(stg_stl: DataFrame, stg_tx: DataFrame) -> DataFrame:
    """One row per settlement line, with its transaction when we have seen one.

    The lag counts from the success, which a later reversal does not move. The lines
    are the preserved side, so a ref that owns many lines is split by skew handling.
    """
    return _with_charge(stg_stl, stg_tx, ["transaction_ref"])


def fct_settlements_by_reference(layout: ByReference) -> DataFrame:
    """The same rows from tables that lie together by reference, without an exchange."""
    return _with_charge(layout.lines, layout.charges, list(KEY))


def _with_charge(lines: DataFrame, charges: DataFrame, keys: list[str]) -> DataFrame:
    charge = charges.select(
        *[F.col(key).alias(f"_{key}") for key in keys],
        F.col("created_at").alias("transaction_created_at"),
        "channel",
        "gateway",
        "successful_at",
    )
    same = [F.col(key) == F.col(f"_{key}") for key in keys]
    return lines.join(charge, same, "left").select(
        "settlement_id",
        "payout_id",
        "transaction_ref",
        "merchant_id",
        "gross_kobo",
        "fee_kobo",
        "net_kobo",
        "currency",
        "settlement_date",
        "settled_at",
        "transaction_created_at",
        "channel",
        "gateway",
        F.datediff("settlement_date", F.to_date("successful_at"))
        .cast("bigint")
        .alias("settlement_lag_days"),
        F.col("_transaction_ref").isNull().alias("is_orphan_settlement"),
    )


def mart_merchant_daily(stg_tx: DataFrame) -> DataFrame:
    """One row per merchant per day. Sums over no success stay null."""
    amount, fee = F.col("amount_ngn_kobo"), F.col("fee_ngn_kobo")
    success = F.col("is_success")
    return stg_tx.groupBy("merchant_id", "event_date").agg(
        F.count("*").alias("attempts"),
        F.count_if(success).alias("successes"),
        F.count_if(F.col("status") == "failed").alias("failures"),
        F.count_if(F.col("is_reversed")).alias("reversals"),
        rate(F.count_if(success), F.count("*"), 4).alias("success_rate"),
        F.sum(amount).alias("gross_attempted_kobo"),
        F.sum(F.when(success, amount)).alias("gross_successful_kobo"),
        F.sum(F.when(success, fee)).alias("fees_kobo"),
        F.sum(F.when(success, amount - fee)).alias("net_successful_kobo"),
        F.count_distinct("customer_id").alias("unique_customers"),
        round_to(F.avg("arrival_lag_seconds"), 1).alias("avg_arrival_lag_seconds"),
        F.max("arrival_lag_seconds").alias("max_arrival_lag_seconds"),
    )


def mart_channel_performance(stg_tx: DataFrame) -> DataFrame:
    """One row per day, channel, bank and gateway, with failures by reason."""
    reasons = [
        F.count_if(F.col("failure_reason") == reason).alias(f"fail_{reason}")
        for reason in FAILURE_REASONS
    ]
    return stg_tx.groupBy(
        "event_date",
        "channel",
        F.coalesce(F.col("bank_code"), F.lit("n/a")).alias("bank_code"),
        "gateway",
    ).agg(
        F.count("*").alias("attempts"),
        F.count_if(F.col("is_success")).alias("successes"),
        rate(F.count_if(F.col("is_success")), F.count("*"), 4).alias("success_rate"),
        F.sum("amount_ngn_kobo").alias("gross_attempted_kobo"),
        *reasons,
    )
