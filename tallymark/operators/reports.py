"""Analyst questions over the facts, the reconciliation mart and the case view.

Group-bys combine on the map side. The share-of-total window runs over rows that are
already aggregated by a small set of fixed values. Listings carry a key as the last
sort column, so a tie at the limit always resolves the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions import naira, round_to

UNSETTLED = ("missing_settlement", "unverified_source")
OFF_AMOUNT = ("short_paid", "partial_settlement", "overpaid")
OUTSTANDING = ("missing_settlement", "short_paid", "partial_settlement", "unverified_source")


def _with_share(counts: DataFrame, count: str, digits: int) -> DataFrame:
    """Add each row's percentage of the total count."""
    total = F.sum(count).over(Window.partitionBy())
    share = F.col(count) * F.lit(100.0) / total
    return counts.withColumn("pct", round_to(share, digits))


# --- Transactions -------------------------------------------------------------------


def status_split(fct_tx: DataFrame) -> DataFrame:
    counts = fct_tx.groupBy("status").agg(F.count("*").alias("tx_count"))
    return _with_share(counts, "tx_count", 1).orderBy(F.desc("tx_count"), "status")


def eligible_by_currency(fct_tx: DataFrame) -> DataFrame:
    return (
        fct_tx.where(F.col("is_settlement_eligible"))
        .groupBy("currency")
        .agg(
            F.count("*").alias("eligible_count"),
            naira(F.sum("amount_ngn_kobo")).alias("total_ngn"),
        )
    )


def lag_split(fct_tx: DataFrame) -> DataFrame:
    return (
        fct_tx.where(F.col("is_settlement_eligible"))
        .groupBy("settlement_lag_days")
        .agg(F.count("*").alias("merchants_tx_count"))
        .orderBy("settlement_lag_days")
    )


def grain_check(fct_tx: DataFrame) -> DataFrame:
    totals = fct_tx.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("transaction_ref").alias("distinct_refs"),
    )
    return totals.withColumn("duplicate_refs", F.col("total_rows") - F.col("distinct_refs"))


def duplicate_refs(fct_tx: DataFrame, key: str = "transaction_ref") -> DataFrame:
    return fct_tx.groupBy(key).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


# --- Settlements --------------------------------------------------------------------


def payout_summary(fct_stl: DataFrame) -> DataFrame:
    totals = fct_stl.agg(
        F.count("*").alias("settlement_lines"),
        F.count_distinct("payout_id").alias("payout_batches"),
    )
    average = F.try_divide(
        F.col("settlement_lines").cast("double"), F.col("payout_batches").cast("double")
    )
    return totals.withColumn("avg_lines_per_batch", round_to(average, 1))


def orphan_count(fct_stl: DataFrame) -> DataFrame:
    return fct_stl.where(F.col("is_orphan_settlement")).agg(
        F.count("*").alias("orphan_settlement_lines")
    )


def lag_histogram(fct_stl: DataFrame) -> DataFrame:
    return (
        fct_stl.where(F.col("settlement_lag_days").isNotNull())
        .groupBy("settlement_lag_days")
        .agg(F.count("*").alias("lines"))
        .orderBy("settlement_lag_days")
    )


def largest_batches(fct_stl: DataFrame, n: int = 10) -> DataFrame:
    return (
        fct_stl.groupBy("payout_id")
        .agg(
            F.count("*").alias("lines_in_batch"),
            naira(F.sum("net_kobo")).alias("batch_net_ngn"),
        )
        .where(F.col("lines_in_batch") > 1)
        .orderBy(F.desc("lines_in_batch"), "payout_id")
        .limit(n)
    )


def daily_throughput(fct_stl: DataFrame) -> DataFrame:
    return (
        fct_stl.groupBy(F.to_date("settled_at").alias("settlement_day"))
        .agg(
            F.count("*").alias("lines_settled"),
            naira(F.sum("net_kobo")).alias("total_settled_ngn"),
        )
        .orderBy("settlement_day")
    )


# --- Reconciliation -----------------------------------------------------------------


def reconciliation_breakdown(recon: DataFrame) -> DataFrame:
    """The headline: how the eligible charges split over the seven outcomes."""
    counts = recon.groupBy("reconciliation_status").agg(F.count("*").alias("row_count"))
    return _with_share(counts, "row_count", 2).orderBy(
        F.desc("row_count"), "reconciliation_status"
    )


def freshness_split(recon: DataFrame) -> DataFrame:
    return recon.groupBy("source_freshness_status").agg(F.count("*").alias("row_count"))


def amount_match_by_currency(recon: DataFrame) -> DataFrame:
    matched = F.col("is_amount_matched")
    return (
        recon.where(F.col("is_settled"))
        .groupBy("currency")
        .agg(
            F.count_if(matched).alias("amount_matched"),
            F.count_if(~matched).alias("amount_mismatched"),
            naira(F.sum("settlement_variance_kobo")).alias("total_variance_ngn"),
        )
    )


def bucket_breakdown(recon: DataFrame) -> DataFrame:
    counts = recon.groupBy("reconciliation_bucket").agg(F.count("*").alias("row_count"))
    return _with_share(counts, "row_count", 2).orderBy(
        F.desc("row_count"), "reconciliation_bucket"
    )


def outstanding_by_currency(recon: DataFrame) -> DataFrame:
    return (
        recon.where(F.col("reconciliation_status").isin(*OUTSTANDING))
        .groupBy("currency")
        .agg(
            naira(F.sum("outstanding_net_kobo")).alias("total_outstanding_ngn"),
            F.count("*").alias("unsettled_tx_count"),
        )
    )


def merchant_health(recon: DataFrame, n: int = 15) -> DataFrame:
    status = F.col("reconciliation_status")
    return (
        recon.groupBy("merchant_id")
        .agg(
            F.count_if(status == "matched").alias("matched"),
            F.count_if(status == "missing_settlement").alias("missing"),
            F.count_if(status == "short_paid").alias("short_paid"),
            naira(F.sum("outstanding_net_kobo")).alias("total_outstanding_ngn"),
        )
        .orderBy(F.desc("total_outstanding_ngn"), "merchant_id")
        .limit(n)
    )


def bucket_summary(recon: DataFrame) -> DataFrame:
    millions = naira(F.sum("outstanding_net_kobo")) / F.lit(1e6)
    return (
        recon.groupBy("reconciliation_bucket")
        .agg(
            F.count("*").alias("transactions"),
            round_to(millions, 2).alias("outstanding_ngn_millions"),
        )
        .orderBy(F.desc("transactions"), "reconciliation_bucket")
    )


def break_totals(recon: DataFrame) -> DataFrame:
    return (
        recon.where(F.col("is_break"))
        .groupBy("break_type")
        .agg(F.count("*").alias("breaks"), F.sum("exposure_kobo").alias("exposure_kobo"))
    )


def oldest_unsettled(recon: DataFrame, n: int = 20) -> DataFrame:
    """Which eligible charges have no settlement, how old, and for how much."""
    return (
        recon.where(F.col("reconciliation_status").isin(*UNSETTLED))
        .select(
            "transaction_ref",
            "merchant_id",
            "currency",
            naira(F.col("expected_net_kobo")).alias("expected_ngn"),
            "expected_settlement_date",
            "days_since_success",
            "reconciliation_status",
            "reconciliation_bucket",
        )
        .orderBy(F.desc("days_since_success"), "transaction_ref")
        .limit(n)
    )


def largest_variances(recon: DataFrame, n: int = 20) -> DataFrame:
    """Money that came, but not the right amount."""
    return (
        recon.where(F.col("reconciliation_status").isin(*OFF_AMOUNT))
        .orderBy(F.abs("settlement_variance_kobo").desc(), "transaction_ref", "settlement_id")
        .limit(n)
        .select(
            "transaction_ref",
            "merchant_id",
            "currency",
            naira(F.col("expected_net_kobo")).alias("expected_ngn"),
            naira(F.col("settled_net_kobo")).alias("settled_ngn"),
            naira(F.col("settlement_variance_kobo")).alias("variance_ngn"),
            naira(F.col("outstanding_net_kobo")).alias("outstanding_ngn"),
            "reconciliation_status",
            "payout_id",
        )
    )


def reversed_after_settlement(recon: DataFrame, n: int = 10) -> DataFrame:
    return (
        recon.where(F.col("reconciliation_status") == "reversed_after_settlement")
        .orderBy("transaction_ref", "settlement_id")
        .limit(n)
        .select(
            "transaction_ref",
            "merchant_id",
            "settled_at",
            "succeeded_at",
            naira(F.col("outstanding_net_kobo")).alias("outstanding_ngn"),
        )
    )


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each served table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in sorted(tables.items())
    ]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out.orderBy("table_name")
