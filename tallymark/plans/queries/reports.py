"""Report queries, listings and set operations."""

from __future__ import annotations

from tallymark.operators import checks
from tallymark.operators import reports as rp
from tallymark.plans import fixtures
from tallymark.plans.queries.base import register
from tallymark.plans.sqltext import sql

_SHARE = "round({n} * 100.0e0 / sum({n}) over (), {digits}) as pct"


def _counted(column: str, table: str, count: str, digits: int) -> str:
    share = _SHARE.format(n=count, digits=digits)
    return (
        f"select {column}, {count}, {share} from"
        f" (select {column}, count(*) as {count} from {table} group by 1)"
    )


register(
    "a08_duplicate_refs",
    lambda ws: rp.duplicate_refs(ws.recon),
    sql(
        "select transaction_ref, count(*) as copies from recon group by 1 having count(*) > 1",
        faulty=True,
    ),
    faulty=True,
)
register(
    "a09_status_split",
    lambda ws: rp.status_split(ws.fct_tx),
    sql(_counted("status", "fct_tx", "tx_count", 1)),
)
register(
    "a10_eligible_by_currency",
    lambda ws: rp.eligible_by_currency(ws.fct_tx),
    sql(
        "select currency, count(*) as eligible_count,"
        " cast(sum(amount_ngn_kobo) as bigint) / 100 as total_ngn"
        " from fct_tx where is_settlement_eligible group by 1"
    ),
)
register(
    "a11_lag_split",
    lambda ws: rp.lag_split(ws.fct_tx),
    sql(
        "select cast(settlement_lag_days as bigint) as settlement_lag_days,"
        " count(*) as merchants_tx_count from fct_tx where is_settlement_eligible group by 1"
    ),
)
register(
    "a12_grain_check",
    lambda ws: rp.grain_check(ws.fct_tx),
    sql(
        "select count(*) as total_rows, count(distinct transaction_ref) as distinct_refs,"
        " count(*) - count(distinct transaction_ref) as duplicate_refs from fct_tx"
    ),
)
register(
    "a13_payout_summary",
    lambda ws: rp.payout_summary(ws.fct_stl),
    sql(
        "select count(*) as settlement_lines, count(distinct payout_id) as payout_batches,"
        " round(count(*) / count(distinct payout_id), 1) as avg_lines_per_batch from fct_stl"
    ),
)
register(
    "a14_orphan_count",
    lambda ws: rp.orphan_count(ws.fct_stl),
    sql(
        "select count(*) as orphan_settlement_lines from fct_stl where is_orphan_settlement",
        faulty=True,
    ),
    faulty=True,
)
register(
    "a15_lag_histogram",
    lambda ws: rp.lag_histogram(ws.fct_stl),
    sql(
        "select settlement_lag_days, count(*) as lines from fct_stl"
        " where settlement_lag_days is not null group by 1",
        faulty=True,
    ),
    faulty=True,
)
register(
    "a16_largest_batches",
    lambda ws: rp.largest_batches(ws.fct_stl),
    sql(
        "select payout_id, count(*) as lines_in_batch,"
        " cast(sum(net_kobo) as bigint) / 100 as batch_net_ngn from fct_stl group by 1"
        " having count(*) > 1 order by lines_in_batch desc, payout_id limit 10"
    ),
)
register(
    "a17_reconciliation_breakdown",
    lambda ws: rp.reconciliation_breakdown(ws.recon),
    sql(_counted("reconciliation_status", "recon", "row_count", 2)),
)
register(
    "a18_freshness_split",
    lambda ws: rp.freshness_split(ws.recon),
    sql("select source_freshness_status, count(*) as row_count from recon group by 1"),
)
register(
    "a19_amount_match_by_currency",
    lambda ws: rp.amount_match_by_currency(ws.recon),
    sql(
        "select currency, count(*) filter (where is_amount_matched) as amount_matched,"
        " count(*) filter (where not is_amount_matched) as amount_mismatched,"
        " cast(sum(settlement_variance_kobo) as bigint) / 100 as total_variance_ngn"
        " from recon where is_settled group by 1",
        faulty=True,
    ),
    faulty=True,
)
register(
    "a20_bucket_breakdown",
    lambda ws: rp.bucket_breakdown(ws.recon),
    sql(_counted("reconciliation_bucket", "recon", "row_count", 2)),
)
register(
    "a21_outstanding_by_currency",
    lambda ws: rp.outstanding_by_currency(ws.recon),
    sql(
        "select currency, cast(sum(outstanding_net_kobo) as bigint) / 100"
        " as total_outstanding_ngn, count(*) as unsettled_tx_count from recon"
        " where reconciliation_status in ('missing_settlement', 'short_paid',"
        " 'partial_settlement', 'unverified_source') group by 1"
    ),
)
register(
    "a22_merchant_health",
    lambda ws: rp.merchant_health(ws.recon),
    sql(
        "select merchant_id, count(*) filter (where reconciliation_status = 'matched') as matched,"
        " count(*) filter (where reconciliation_status = 'missing_settlement') as missing,"
        " count(*) filter (where reconciliation_status = 'short_paid') as short_paid,"
        " cast(sum(outstanding_net_kobo) as bigint) / 100 as total_outstanding_ngn"
        " from recon group by 1 order by total_outstanding_ngn desc, merchant_id limit 15"
    ),
)
register(
    "a23_daily_throughput",
    lambda ws: rp.daily_throughput(ws.fct_stl),
    sql(
        "select cast(cast(settled_at as date) as varchar) as settlement_day,"
        " count(*) as lines_settled, cast(sum(net_kobo) as bigint) / 100 as total_settled_ngn"
        " from fct_stl group by 1"
    ),
)
register(
    "a24_bucket_summary",
    lambda ws: rp.bucket_summary(ws.recon),
    sql(
        "select reconciliation_bucket, count(*) as transactions,"
        " round(cast(sum(outstanding_net_kobo) as bigint) / 100 / 1e6, 2)"
        " as outstanding_ngn_millions from recon group by 1"
    ),
)
register(
    "a26_break_totals",
    lambda ws: rp.break_totals(ws.recon),
    sql(
        "select break_type, count(*) as breaks, cast(sum(exposure_kobo) as bigint)"
        " as exposure_kobo from recon where is_break group by 1"
    ),
)
register(
    "w03_share_of_total",
    lambda ws: rp.reconciliation_breakdown(ws.recon).select("reconciliation_status", "pct"),
    sql(
        "select reconciliation_status, pct from ("
        + _counted("reconciliation_status", "recon", "row_count", 2)
        + ")",
        faulty=True,
    ),
    faulty=True,
)
register(
    "l01_oldest_unsettled",
    lambda ws: rp.oldest_unsettled(ws.recon),
    sql(
        "select transaction_ref, merchant_id, currency, expected_net_kobo / 100 as expected_ngn,"
        " cast(expected_settlement_date as varchar) as expected_settlement_date,"
        " days_since_success, reconciliation_status, reconciliation_bucket from recon"
        " where reconciliation_status in ('missing_settlement', 'unverified_source')"
        " order by days_since_success desc, transaction_ref limit 20"
    ),
)
register(
    "l02_largest_variances",
    lambda ws: rp.largest_variances(ws.recon),
    sql(
        "select transaction_ref, merchant_id, currency, expected_net_kobo / 100 as expected_ngn,"
        " settled_net_kobo / 100 as settled_ngn, settlement_variance_kobo / 100 as variance_ngn,"
        " outstanding_net_kobo / 100 as outstanding_ngn, reconciliation_status, payout_id"
        " from recon where reconciliation_status in"
        " ('short_paid', 'partial_settlement', 'overpaid')"
        " order by abs(settlement_variance_kobo) desc, transaction_ref, settlement_id limit 20"
    ),
)
register(
    "l03_reversed_after_settlement",
    lambda ws: rp.reversed_after_settlement(ws.recon),
    sql(
        "select transaction_ref, merchant_id, cast(epoch(settled_at) as bigint) as settled_at,"
        " cast(epoch(succeeded_at) as bigint) as succeeded_at,"
        " outstanding_net_kobo / 100 as outstanding_ngn from recon"
        " where reconciliation_status = 'reversed_after_settlement'"
        " order by transaction_ref, settlement_id limit 10"
    ),
)
register(
    "s18_break_rows",
    lambda ws: fixtures.break_feed(ws.recon),
    sql(
        "select case_id, transaction_ref, merchant_id, channel, gateway, bank_code, currency,"
        " cast(succeeded_date as varchar) as succeeded_date, amount_ngn_kobo, expected_net_kobo,"
        " settled_net_kobo, break_type, exposure_kobo from breaks",
        faulty=True,
    ),
    faulty=True,
)
register(
    "s19_table_inventory",
    lambda ws: rp.table_inventory(ws.tables()),
    sql(
        "select 'fct_transactions' as table_name, count(*) as row_count from fct_tx union all"
        " select 'fct_settlements', count(*) from fct_stl union all"
        " select 'mart_settlement_reconciliation', count(*) from recon union all"
        " select 'mart_merchant_daily', count(*) from daily union all"
        " select 'mart_channel_performance', count(*) from channels"
    ),
)

_RANGE = """
select 'mart_merchant_daily' as model, merchant_id as grain, success_rate from daily_broken
where success_rate < 0 or success_rate > 1 union all
select 'mart_channel_performance', channel, success_rate from channels_broken
where success_rate < 0 or success_rate > 1"""
register(
    "u01_rates_of_two_marts",
    lambda ws: checks.success_rate_out_of_range(
        fixtures.break_success_rate(ws.daily), fixtures.break_success_rate(ws.channels)
    ),
    sql(_RANGE),
)
register(
    "u03_bag_difference",
    lambda ws: checks.bag_difference(
        ws.raw_transactions(), fixtures.lost_and_doubled(ws.raw_transactions()), "event_id"
    ),
    sql(
        "select event_id, if(n > 0, 'missing', 'extra') as side, abs(n)::bigint as copies from"
        " (select event_id, sum(one) as n from (select event_id, 1 as one from tx_raw union all"
        " select event_id, -1 from tx_raw_off) group by 1) where n <> 0"
    ),
)
register(
    "j10_compare_bags",
    lambda ws: checks.compare_bags(
        ws.raw_transactions(), fixtures.lost_and_doubled(ws.raw_transactions()), "event_id"
    ),
    sql("""
select cast(sum(e) as bigint) as expected, cast(sum(f) as bigint) as found,
  cast(sum(greatest(0, f - e)) as bigint) as extra,
  cast(sum(greatest(0, e - f)) as bigint) as missing,
  sum(greatest(0, f - e)) = 0 and sum(greatest(0, e - f)) = 0 as exact
from (select a.event_id, a.n as e, coalesce(b.n, 0) as f
  from (select event_id, count(*) as n from tx_raw group by 1) a
  left join (select event_id, count(*) as n from tx_raw_off group by 1) b using (event_id))"""),
)
