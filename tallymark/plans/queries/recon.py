"""Queries on facts, marts, the reconciliation mart and its joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.operators import checks, distinct, incremental, marts, staging
from tallymark.operators import reconcile as rc
from tallymark.plans.queries.base import register
from tallymark.plans.sqltext import cols, sql
from tallymark.sources.tables import materialize

FCT_TX = (
    "transaction_ref merchant_id customer_id gateway channel bank_code status currency"
    " failure_reason amount_kobo fee_kobo amount_ngn_kobo fee_ngn_kobo net_ngn_kobo fx_rate_to_ngn"
    " created_at:t updated_at:t successful_at:t ingested_at:t event_date:d arrival_lag_seconds"
    " settlement_lag_days:i expected_settlement_date:d settlement_source_watermark_at:t is_success"
    " is_reversed is_settlement_eligible"
)
FCT_STL = (
    "settlement_id payout_id transaction_ref merchant_id gross_kobo fee_kobo net_kobo currency"
    " settlement_date:d settled_at:t transaction_created_at:t channel gateway settlement_lag_days"
    " is_orphan_settlement"
)
RECON = (
    "transaction_ref merchant_id channel gateway bank_code currency amount_ngn_kobo fee_ngn_kobo"
    " succeeded_at:t succeeded_date:d expected_settlement_date:d settlement_source_watermark_at:t"
    " settlement_id payout_id settlement_date:d settled_at:t settled_net_kobo as_of_date:d"
    " days_since_success is_settled is_amount_matched expected_net_kobo settlement_variance_kobo"
    " source_freshness_status reconciliation_status reconciliation_bucket outstanding_net_kobo"
    " is_break case_id break_type exposure_kobo"
)
ELIGIBLE = (
    "transaction_ref merchant_id status currency amount_ngn_kobo fee_ngn_kobo"
    " expected_settlement_date:d"
)
DAILY = (
    "merchant_id event_date:d attempts successes failures reversals success_rate"
    " gross_attempted_kobo gross_successful_kobo fees_kobo net_successful_kobo unique_customers"
    " avg_arrival_lag_seconds max_arrival_lag_seconds"
)
CHANNELS = (
    "event_date:d channel bank_code gateway attempts successes success_rate gross_attempted_kobo"
    " fail_insufficient_funds fail_do_not_honour fail_invalid_pin fail_timeout fail_limit_exceeded"
    " fail_suspected_fraud"
)


def _names(spec: str) -> list[str]:
    return [item.partition(":")[0] for item in spec.split()]


register(
    "f01_fct_transactions",
    lambda ws: marts.fct_transactions(ws.stg_transactions()),
    sql(f"select {cols(FCT_TX)} from fct_tx"),
)
register(
    "f02_fct_settlements",
    lambda ws: marts.fct_settlements_by_reference(ws.by_reference()),
    sql(f"select {cols(FCT_STL)} from fct_stl"),
)
register(
    "f03_orphan_flag",
    lambda ws: marts.fct_settlements(ws.stg_settlements(), ws.stg_transactions()).select(
        "settlement_id", "transaction_ref", "is_orphan_settlement"
    ),
    sql("select settlement_id, transaction_ref, is_orphan_settlement from fct_stl", faulty=True),
    faulty=True,
)
register(
    "f04_as_of",
    lambda ws: rc.as_of(ws.stg_transactions()),
    sql("select cast(cast(max(ingested_at) as date) as varchar) as as_of_date from stg_tx"),
)
register(
    "f05_eligible",
    lambda ws: rc.eligible(ws.stg_transactions(), ws.stg_settlements()).select(*_names(ELIGIBLE)),
    sql(f"select {cols(ELIGIBLE)} from charges_due"),
)
register(
    "f06_with_lines",
    lambda ws: rc.with_lines(ws.stg_transactions(), ws.stg_settlements()).select(
        "transaction_ref", "settlement_id", "settled_net_kobo", "as_of_date", "days_since_success"
    ),
    sql(
        "select transaction_ref, settlement_id, settled_net_kobo,"
        " cast(as_of_date as varchar) as as_of_date, days_since_success from recon",
        faulty=True,
    ),
    faulty=True,
)
for _key, _columns in (
    ("f07_settled_and_matched", "transaction_ref is_settled is_amount_matched"),
    ("f08_expected_and_variance", "transaction_ref expected_net_kobo settlement_variance_kobo"),
    ("f09_source_freshness", "transaction_ref source_freshness_status"),
    ("f10_reconciliation_status", "transaction_ref reconciliation_status"),
    ("f11_reconciliation_bucket", "transaction_ref reconciliation_bucket"),
    ("f12_outstanding", "transaction_ref outstanding_net_kobo"),
    ("f13_is_break", "transaction_ref is_break"),
    ("f14_case_id", "transaction_ref case_id"),
    ("f15_break_type", "transaction_ref break_type"),
    ("f16_exposure", "transaction_ref exposure_kobo"),
):
    register(
        _key,
        lambda ws, c=_columns: rc.reconcile(ws.stg_transactions(), ws.stg_settlements()).select(
            *c.split()
        ),
        sql(f"select {cols(_columns)} from recon", faulty=True),
        faulty=True,
    )
register(
    "f17_reconciliation_mart",
    lambda ws: rc.reconcile_by_reference(ws.by_reference()),
    sql(f"select {cols(RECON)} from recon"),
)

# --- Joins ---------------------------------------------------------------------------

register(
    "j01_settlement_to_transaction",
    lambda ws: marts.fct_settlements(ws.stg_settlements(), ws.stg_transactions()).select(
        "settlement_id", "transaction_ref", "channel", "settlement_lag_days"
    ),
    sql(
        "select settlement_id, transaction_ref, channel, settlement_lag_days from fct_stl",
        faulty=True,
    ),
    faulty=True,
)
register(
    "j02_charge_to_line",
    lambda ws: rc.with_lines_by_reference(ws.by_reference()).select(
        "transaction_ref", "settlement_id", "payout_id"
    ),
    sql("select transaction_ref, settlement_id, payout_id from recon"),
)
register(
    "j03_reporting_date_on_every_row",
    lambda ws: rc.with_lines(ws.stg_transactions(), ws.stg_settlements())
    .groupBy("as_of_date")
    .agg(F.count("*").alias("mart_rows")),
    sql("select cast(as_of_date as varchar) as as_of_date, count(*) as mart_rows"
        " from recon group by 1"),
)
register(
    "j04_exists_for_reversed",
    lambda ws: rc.eligible(ws.stg_transactions(), ws.stg_settlements())
    .where(F.col("is_reversed"))
    .select("transaction_ref", "status"),
    sql("select transaction_ref, status from charges_due where status = 'reversed'"),
)
register(
    "j05_expected_mart_rows",
    lambda ws: checks.expected_mart_rows(ws.fct_tx, ws.fct_stl),
    sql(
        "select count(*) as expected_rows from fct_tx where is_settlement_eligible or"
        " (is_reversed and transaction_ref in (select transaction_ref from fct_stl))"
    ),
)
register(
    "j06_settled_without_line",
    lambda ws: checks.settled_without_line(
        ws.recon, ws.fct_stl.where(F.substring("settlement_id", -1, 1) != "7")
    ),
    sql(
        "select transaction_ref, settlement_id from recon r where is_settled and not exists ("
        "select 1 from fct_stl s where s.transaction_ref = r.transaction_ref"
        " and right(s.settlement_id, 1) <> '7')"
    ),
)
register(
    "j08_settlement_without_transaction",
    lambda ws: checks.check_relationship(
        ws.stg_settlements(), ws.stg_transactions(), "transaction_ref"
    ).select("settlement_id", "transaction_ref"),
    sql(
        "select settlement_id, transaction_ref from stg_stl s where not exists ("
        "select 1 from stg_tx t where t.transaction_ref = s.transaction_ref)",
        faulty=True,
    ),
    faulty=True,
)

# --- Marts ---------------------------------------------------------------------------

register(
    "a01_merchant_daily",
    lambda ws: marts.mart_merchant_daily(ws.stg_transactions()),
    sql(f"select {cols(DAILY)} from daily"),
)
for _key, _columns in (
    ("a02_filtered_counts", "merchant_id event_date:d attempts successes failures reversals"),
    ("a03_filtered_sums",
     "merchant_id event_date:d gross_successful_kobo fees_kobo net_successful_kobo"),
    ("a04_distinct_customers", "merchant_id event_date:d unique_customers"),
    ("a05_success_rate", "merchant_id event_date:d success_rate"),
    ("a06_arrival_lag",
     "merchant_id event_date:d avg_arrival_lag_seconds max_arrival_lag_seconds"),
):
    register(
        _key,
        lambda ws, c=_columns: marts.mart_merchant_daily(ws.stg_transactions()).select(*_names(c)),
        sql(f"select {cols(_columns)} from daily"),
    )
register(
    "a07_channel_performance",
    lambda ws: marts.mart_channel_performance(ws.stg_transactions()),
    sql(f"select {cols(CHANNELS)} from channels"),
)


# --- Marts from changes and sketches ---------------------------------------------------


def _in_increments(ws, rolling):
    """The mart after raw events came in three parts: the state of the first, refreshed by what
    the second and the third change."""
    raw = ws.raw_transactions().withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(3)))
    state = before = None
    for part in range(3):
        known = raw.where(F.col("part") <= part).drop("part")
        after = staging.stg_transactions(
            ws.staged_rows("transactions", staging.stage_transactions(known))
        )
        if state is None:
            state = rolling.state(after)
        else:
            old, new = incremental.changed_rows(before, after, raw.where(F.col("part") == part))
            state = rolling.refresh(state, old, new, after)
        state, before = materialize(state, "rolling"), after
    return rolling.mart(state)


register(
    "a01_merchant_daily_in_increments",
    lambda ws: _in_increments(ws, incremental.merchant_daily()),
    sql(f"select {cols(DAILY)} from daily"),
)
register(
    "a07_channel_performance_in_increments",
    lambda ws: _in_increments(ws, incremental.channel_performance()),
    sql(f"select {cols(CHANNELS)} from channels"),
)


def _weekly_customers(ws):
    charges = ws.stg_transactions()
    week = F.date_trunc("week", "event_date").cast("date")
    spans = {"merchant_id": F.col("merchant_id"), "week": week}
    estimates = distinct.rollup_customers(materialize(distinct.daily_customers(charges), "customers"), **spans)
    exact = charges.groupBy("merchant_id", week.alias("week")).agg(
        F.count_distinct("customer_id").alias("unique_customers")
    )
    near = distinct.within_error(F.col("customers_estimate"), F.col("unique_customers"))
    return exact.join(estimates, ["merchant_id", "week"]).select(
        "merchant_id", "week", "unique_customers", near.alias("within_error")
    )


register(
    "a04_rollup",
    _weekly_customers,
    sql(
        "select merchant_id, cast(cast(date_trunc('week', event_date) as date) as varchar) as week,"
        " count(distinct customer_id) as unique_customers, true as within_error from stg_tx group by 1, 2"
    ),
)
