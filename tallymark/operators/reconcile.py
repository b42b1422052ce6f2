"""The reconciliation mart: which successful charges have been paid out, and how well.

    with_lines -> classify -> flag -> identify

Each step takes and returns a DataFrame; `reconcile` composes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import case_id
from tallymark.sources.by_reference import KEY, ByReference

CHARGE_COLUMNS = (
    "transaction_ref",
    "merchant_id",
    "channel",
    "gateway",
    "bank_code",
    "currency",
    "amount_ngn_kobo",
    "fee_ngn_kobo",
    "succeeded_at",
    "succeeded_date",
    "expected_settlement_date",
    "settlement_source_watermark_at",
    "status",
)
LINE_COLUMNS = ("settlement_id", "payout_id", "settlement_date", "settled_at", "settled_net_kobo")


def as_of(stg_tx: DataFrame) -> DataFrame:
    """The reporting date comes from the input, so the same input gives the same mart."""
    return stg_tx.agg(F.to_date(F.max("ingested_at")).alias("as_of_date"))


def eligible(stg_tx: DataFrame, stg_stl: DataFrame) -> DataFrame:
    """Successful charges, plus reversed ones that some settlement line names.

    The two sets cannot overlap, so EXISTS is needed for the few reversed rows only.
    """
    settled_refs = stg_stl.select("transaction_ref").distinct()
    success = stg_tx.where(F.col("is_settlement_eligible"))
    reversed_ = stg_tx.where(F.col("is_reversed")).join(settled_refs, "transaction_ref", "semi")
    return success.unionByName(reversed_)


def _charges(stg_tx: DataFrame, *more: str) -> DataFrame:
    return stg_tx.withColumns(
        {
            "succeeded_at": F.col("successful_at"),
            "succeeded_date": F.to_date("successful_at"),
        }
    ).select(*CHARGE_COLUMNS, *more)


def _lines(stg_stl: DataFrame, *more: str) -> DataFrame:
    paid = [F.col("net_kobo").alias(c) if c == "settled_net_kobo" else c for c in LINE_COLUMNS]
    return stg_stl.select("transaction_ref", *paid, *more)


def _dated(rows: DataFrame, day: Column) -> DataFrame:
    days = F.datediff("as_of_date", "succeeded_date").cast("bigint")
    return rows.withColumn("as_of_date", day).withColumn("days_since_success", days)


def with_lines(stg_tx: DataFrame, stg_stl: DataFrame) -> DataFrame:
    """Eligible charges left-joined to their settlement lines, with the reporting date.

    Written as an inner join plus an anti join. An inner join may be split on either
    side when one ref owns a large share of the lines; the null-supplying side of an
    outer join may not. It also decides EXISTS for reversed charges on the way: they
    count only where the inner join finds a line. Two lines for one charge stay two
    rows; the uniqueness check reports them.
    """
    lines = _lines(stg_stl)
    charges = _charges(stg_tx.where(F.col("is_settlement_eligible") | F.col("is_reversed")))
    open_charges = _charges(stg_tx.where(F.col("is_settlement_eligible")))

    settled = lines.join(charges, "transaction_ref").select(*CHARGE_COLUMNS, *LINE_COLUMNS)
    unsettled = open_charges.join(
        lines.select("transaction_ref").distinct(), "transaction_ref", "anti"
    )
    both = settled.unionByName(unsettled, allowMissingColumns=True)
    return _dated(both, as_of(stg_tx).scalar())


def with_lines_by_reference(layout: ByReference) -> DataFrame:
    """The same rows from tables that lie together by reference: one join, no exchange.

    A reference with slots has lines, so none of its repeated charges may stand alone.
    """
    lines = _lines(layout.lines, *KEY[1:])
    wanted = layout.charges.where(F.col("is_settlement_eligible") | F.col("is_reversed"))
    charges = _charges(wanted, "is_settlement_eligible", "ref_slots", *KEY[1:])
    alone = F.col("is_settlement_eligible") & (F.col("ref_slots") == 1)
    both = charges.join(lines, list(KEY), "left").where(F.col("settlement_id").isNotNull() | alone)
    return _dated(both.select(*CHARGE_COLUMNS, *LINE_COLUMNS), F.lit(layout.as_of).cast("date"))


def classify(joined: DataFrame) -> DataFrame:
    """Status, bucket, freshness and money of each row. The order of cases is the rule."""
    has_line = F.col("settlement_id").isNotNull()
    expected = F.col("amount_ngn_kobo") - F.col("fee_ngn_kobo")
    settled = F.col("settled_net_kobo")
    was_reversed = F.col("status") == "reversed"
    source_day = F.to_date("settlement_source_watermark_at")
    due = F.col("expected_settlement_date")
    days = F.col("days_since_success")

    status = (
        F.when(was_reversed & has_line, "reversed_after_settlement")
        .when(~has_line & (source_day < due), "unverified_source")
        .when(~has_line, "missing_settlement")
        .when(settled == expected, "matched")
        # below 90 % of what is due, in whole kobo
        .when(settled * 10 < expected * 9, "partial_settlement")
        .when(settled < expected, "short_paid")
        .otherwise("overpaid")
    )
    bucket = (
        F.when(has_line, "settled")
        .when(source_day < due, "pending_within_sla")
        .when(days <= 1, "pending_t1")
        .when(days == 2, "pending_t2")
        .when(F.col("as_of_date") <= due, "pending_within_sla")
        .otherwise("breached_sla")
    )
    outstanding = (
        F.when(~has_line, expected)
        .when(was_reversed, F.lit(0).cast("bigint"))
        .otherwise(F.greatest(F.lit(0).cast("bigint"), expected - settled))
    )
    return joined.select(
        *[c for c in CHARGE_COLUMNS if c != "status"],
        *LINE_COLUMNS,
        "as_of_date",
        "days_since_success",
        has_line.alias("is_settled"),
        (has_line & (settled == expected)).alias("is_amount_matched"),
        expected.alias("expected_net_kobo"),
        F.when(has_line, settled - expected).alias("settlement_variance_kobo"),
        F.when(source_day >= due, "fresh")
        .otherwise("stale_or_incomplete")
        .alias("source_freshness_status"),
        status.alias("reconciliation_status"),
        bucket.alias("reconciliation_bucket"),
        outstanding.alias("outstanding_net_kobo"),
    )


def flag(classified: DataFrame) -> DataFrame:
    """A break is money that came wrong, or never came and is overdue."""
    status = F.col("reconciliation_status")
    wrong = status.isin("short_paid", "partial_settlement", "overpaid", "reversed_after_settlement")
    overdue = (status == "missing_settlement") & (F.col("reconciliation_bucket") == "breached_sla")
    return classified.withColumn("is_break", wrong | overdue)


def identify(flagged: DataFrame) -> DataFrame:
    """Case identity, break type and the money at risk."""
    exposure = (
        F.when(~F.col("is_break"), F.lit(0).cast("bigint"))
        .when(F.col("settlement_id").isNull(), F.col("expected_net_kobo"))
        .when(
            F.col("reconciliation_status") == "reversed_after_settlement",
            F.col("settled_net_kobo"),
        )
        .otherwise(F.abs("settlement_variance_kobo"))
    )
    return flagged.withColumns(
        {
            "case_id": case_id(F.col("transaction_ref")),
            "break_type": F.when(F.col("is_break"), F.col("reconciliation_status")),
            "exposure_kobo": exposure,
        }
    )


def reconcile(stg_tx: DataFrame, stg_stl: DataFrame) -> DataFrame:
    """The whole mart, 31 columns."""
    return identify(flag(classify(with_lines(stg_tx, stg_stl))))


def reconcile_by_reference(layout: ByReference) -> DataFrame:
    """The whole mart from tables that lie together by reference."""
    return identify(flag(classify(with_lines_by_reference(layout))))
