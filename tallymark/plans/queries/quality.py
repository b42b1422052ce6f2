"""Queries of the data-quality checks. Each runs on data that violates it somewhere."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.operators import checks as ck
from tallymark.operators import fingerprints as fp
from tallymark.operators import staging
from tallymark.plans import fixtures
from tallymark.plans.queries.base import register
from tallymark.plans.sqltext import sql

SQL_NAMES = {
    "stg_transactions": "stg_tx",
    "stg_settlements": "stg_stl",
    "fct_transactions": "fct_tx",
    "fct_settlements": "fct_stl",
    "mart_settlement_reconciliation": "recon",
    "mart_merchant_daily": "daily",
    "mart_channel_performance": "channels",
}
BROKEN_SQL = {
    **SQL_NAMES,
    "stg_transactions": "stg_tx_broken",
    "mart_settlement_reconciliation": "recon_broken",
}


def _all_tables(ws) -> dict:
    return {
        "stg_transactions": ws.stg_transactions(),
        "stg_settlements": ws.stg_settlements(),
        **ws.tables(),
    }


def _broken_tables(ws) -> dict:
    return {
        **_all_tables(ws),
        "stg_transactions": fixtures.break_stg_transactions(ws.stg_transactions()),
        "mart_settlement_reconciliation": fixtures.break_recon(ws.recon),
    }


# a fact that is not known to be true is broken
_BREAK_FLAGS_OFF = (
    "not coalesce((is_break = (break_type is not null)) and length(case_id) = 64"
    " and if(is_break, exposure_kobo >= 0, exposure_kobo = 0)"
    " and not (reconciliation_status = 'matched' and is_break)"
    " and not (reconciliation_status = 'missing_settlement'"
    " and reconciliation_bucket = 'breached_sla' and not is_break), false)"
)


def _quoted(values) -> str:
    return ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values)


_UNIQUE = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, count(*) as violations from"
    f" (select {c} from {SQL_NAMES[t]} where {c} is not null group by 1 having count(*) > 1)"
    for t, c in ck.UNIQUE
)
_NOT_NULL = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name,"
    f" count(*) filter (where {c} is null) as violations from {BROKEN_SQL[t]}"
    for t, columns in ck.NOT_NULL.items()
    for c in columns
)
_ACCEPTED = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name,"
    f" count(*) filter (where {c} not in ({_quoted(values)})) as violations from {BROKEN_SQL[t]}"
    for t, allowed in ck.ACCEPTED.items()
    for c, values in allowed.items()
)

register("c01_unique", lambda ws: ck.unique_rules(_all_tables(ws)), sql(_UNIQUE, True), True)
register("c02_not_null", lambda ws: ck.not_null_rules(_broken_tables(ws)), sql(_NOT_NULL))
register("c03_accepted_values", lambda ws: ck.accepted_rules(_broken_tables(ws)), sql(_ACCEPTED))
register(
    "c04_relationship",
    lambda ws: ck.check_relationship(
        ws.stg_settlements(), ws.stg_transactions(), "transaction_ref"
    ).agg(F.count("*").alias("violations")),
    sql(
        "select count(*) as violations from stg_stl where transaction_ref not in"
        " (select transaction_ref from stg_tx)",
        faulty=True,
    ),
    faulty=True,
)
register(
    "c05_break_flags",
    lambda ws: ck.break_flags_inconsistent(fixtures.break_recon(ws.recon)),
    sql("""
select transaction_ref, reconciliation_status, is_break, break_type, exposure_kobo
from recon_broken where """ + _BREAK_FLAGS_OFF),
)
register(
    "c06_negative_money",
    lambda ws: ck.negative_money(fixtures.break_fct_transactions(ws.fct_tx)),
    sql(
        "select transaction_ref, amount_ngn_kobo, fee_ngn_kobo, net_ngn_kobo from fct_tx_broken"
        " where net_ngn_kobo < 0 or fee_ngn_kobo < 0 or amount_ngn_kobo < 0"
    ),
)
register(
    "c07_matched_with_outstanding",
    lambda ws: ck.matched_with_outstanding(fixtures.break_recon(ws.recon)),
    sql(
        "select transaction_ref, outstanding_net_kobo from recon_broken"
        " where is_amount_matched and outstanding_net_kobo <> 0"
    ),
)
register(
    "c08_settled_before_charge",
    lambda ws: ck.settled_before_charge(fixtures.break_fct_settlements(ws.fct_stl)),
    sql(
        "select settlement_id, transaction_ref, settlement_lag_days from fct_stl_broken"
        " where settlement_lag_days < 0 and not is_orphan_settlement",
        faulty=True,
    ),
    faulty=True,
)
register(
    "c09_success_rate_range",
    lambda ws: ck.success_rate_out_of_range(
        fixtures.break_success_rate(ws.daily), fixtures.break_success_rate(ws.channels)
    )
    .groupBy("model")
    .agg(F.count("*").alias("violations")),
    sql(
        "select 'mart_merchant_daily' as model, count(*) as violations from daily_broken"
        " where success_rate not between 0 and 1 union all"
        " select 'mart_channel_performance', count(*) from channels_broken"
        " where success_rate not between 0 and 1"
    ),
)
register(
    "c10_usd_without_rate",
    lambda ws: ck.usd_without_rate(fixtures.break_fct_transactions(ws.fct_tx)),
    sql(
        "select transaction_ref, currency, fx_rate_to_ngn, amount_ngn_kobo from fct_tx_broken"
        " where currency = 'USD' and (fx_rate_to_ngn is null or fx_rate_to_ngn <= 0)",
        faulty=True,
    ),
    faulty=True,
)


def _non_empty(name: str, table: str) -> str:
    return (
        f"select '{name}_non_empty' as check_name, 'hard' as severity,"
        f" case when count(*) = 0 then 1 else 0 end as violations from {table}"
    )


_MARTS = (
    "fct_transactions",
    "fct_settlements",
    "mart_settlement_reconciliation",
    "mart_merchant_daily",
    "mart_channel_performance",
)
_REPORT = f"""
select *, case when violations = 0 then 'pass' when severity = 'soft' then 'warn' else 'fail' end
  as outcome from (
{" union all ".join(_non_empty(m, SQL_NAMES[m]) for m in _MARTS)}
union all select 'fct_transactions_unique_ref', 'hard', count(*) from
  (select transaction_ref from fct_tx group by 1 having count(*) > 1)
union all select 'matched_rows_zero_outstanding', 'hard', count(*) from recon
  where is_amount_matched and outstanding_net_kobo <> 0
union all select 'matched_reconciliation_consistency', 'hard', count(*) from recon
  where reconciliation_status = 'matched' and (settlement_variance_kobo <> 0
    or outstanding_net_kobo <> 0 or not is_amount_matched)
union all select 'reconciliation_ties_to_fact', 'hard', abs((select count(*) from recon)
  - (select count(*) from fct_tx where is_settlement_eligible or (is_reversed
     and transaction_ref in (select transaction_ref from fct_stl))))
union all select 'ngn_amount_discrepancies', 'soft', count(*) from recon
  where currency = 'NGN' and is_settled and not is_amount_matched
union all select 'usd_rows_with_variance', 'soft', count(*) from recon
  where currency = 'USD' and is_settled and settlement_variance_kobo <> 0)"""
register(
    "c11_marts_non_empty",
    lambda ws: ck.serving_report(ws.tables()).where(F.col("check_name").endswith("_non_empty")),
    sql(f"select * from ({_REPORT}) where check_name like '%_non_empty'"),
)
register(
    "c12_fact_grain",
    lambda ws: ck.check_unique(
        ws.fct_tx.unionByName(
            ws.fct_tx.where(fixtures.ref_key(F.col("transaction_ref")) % 43 == 2)
        ),
        "transaction_ref",
    ),
    sql(
        "select transaction_ref, count(*) as copies from (select transaction_ref from fct_tx"
        " union all select transaction_ref from fct_tx"
        " where cast(substr(transaction_ref, 4, 10) as bigint) % 43 = 2)"
        " group by 1 having count(*) > 1"
    ),
)
_DELTA = """
select a as reconciliation_rows, b as expected_rows, a - b as row_delta from (
select (select count(*) from recon) as a, (select count(*) from fct_tx where
  is_settlement_eligible or (is_reversed and transaction_ref in
  (select transaction_ref from fct_stl))) as b)"""
register(
    "c13_ties_to_fact",
    lambda ws: ck.mart_row_delta(ws.recon, ck.expected_mart_rows_by_reference(ws.by_reference())),
    sql(_DELTA),
)
register(
    "c13_ties_to_fact_with_extra_lines",
    lambda ws: ck.mart_row_delta(ws.recon, ck.expected_mart_rows(ws.fct_tx, ws.fct_stl)),
    sql(_DELTA, faulty=True),
    faulty=True,
)
register(
    "c14_inconsistent_matched",
    lambda ws: ck.inconsistent_matched(fixtures.break_recon(ws.recon)),
    sql(
        "select transaction_ref, settlement_variance_kobo, outstanding_net_kobo,"
        " is_amount_matched from recon_broken where reconciliation_status = 'matched' and"
        " (settlement_variance_kobo <> 0 or outstanding_net_kobo <> 0 or not is_amount_matched)"
    ),
)
register(
    "c15_amount_discrepancies",
    lambda ws: ck.amount_discrepancies(ws.recon),
    sql(
        "select count(*) filter (where currency = 'NGN' and is_settled and not is_amount_matched)"
        " as ngn_amount_discrepancies, count(*) filter (where currency = 'USD' and is_settled"
        " and settlement_variance_kobo <> 0) as usd_rows_with_variance from recon",
        faulty=True,
    ),
    faulty=True,
)
register(
    "c16_settled_without_line",
    lambda ws: ck.settled_without_line(ws.recon, fixtures.break_fct_settlements(ws.fct_stl)),
    sql(
        "select transaction_ref, settlement_id from recon where is_settled and"
        " transaction_ref not in (select transaction_ref from fct_stl_broken)"
    ),
)
register(
    "c17_serving_report",
    lambda ws: ck.serving_report(ws.tables()),
    sql(_REPORT, faulty=True),
    faulty=True,
)
# --- the gate: every data test on tables with faults

_ALL_BROKEN = {
    "stg_transactions": "stg_tx_broken",
    "stg_settlements": "stg_stl",
    "fct_transactions": "fct_tx_broken",
    "fct_settlements": "fct_stl_broken",
    "mart_settlement_reconciliation": "recon_broken",
    "mart_merchant_daily": "daily_broken",
    "mart_channel_performance": "channels_broken",
}
_ROW_TESTS = {
    "fct_transactions": {
        "negative_money": "least(net_ngn_kobo, fee_ngn_kobo, amount_ngn_kobo) < 0",
        "usd_without_rate": "currency = 'USD' and coalesce(fx_rate_to_ngn, 0) <= 0",
    },
    "fct_settlements": {
        "settled_before_charge": "settlement_lag_days < 0 and not is_orphan_settlement"
    },
    "mart_settlement_reconciliation": {
        "break_flags": _BREAK_FLAGS_OFF,
        "matched_with_outstanding": "is_amount_matched and outstanding_net_kobo <> 0",
        "inconsistent_matched": "reconciliation_status = 'matched' and (settlement_variance_kobo"
        " <> 0 or outstanding_net_kobo <> 0 or not is_amount_matched)",
        "stale_but_missing": "source_freshness_status = 'stale_or_incomplete'"
        " and reconciliation_status = 'missing_settlement'",
    },
    "mart_merchant_daily": {"success_rate_range": "success_rate not between 0 and 1"},
    "mart_channel_performance": {"success_rate_range": "success_rate not between 0 and 1"},
}


def _tests_sql() -> str:
    rules = [(t, name, where) for t, of in _ROW_TESTS.items() for name, where in of.items()]
    rules += [(t, f"not_null_{c}", f"{c} is null") for t, cs in ck.NOT_NULL.items() for c in cs]
    rules += [
        (t, f"accepted_{c}", f"{c} not in ({_quoted(values)})")
        for t, of in ck.ACCEPTED.items()
        for c, values in of.items()
    ]
    rules.append(
        ("stg_settlements", "line_has_charge", "transaction_ref not in (select transaction_ref from stg_tx_broken)")
    )
    parts = [
        f"select '{t}' as table_name, '{name}' as rule, count(*) as violations"
        f" from {_ALL_BROKEN[t]} where {where}"
        for t, name, where in rules
    ]
    parts += [
        f"select '{t}', 'unique_{c}', count(*) from (select {c} from {_ALL_BROKEN[t]}"
        f" where {c} is not null group by 1 having count(*) > 1)"
        for t, c in ck.UNIQUE
    ]
    parts.append(
        "select 'mart_settlement_reconciliation', 'ties_to_fact', abs((select count(*) from"
        " recon_broken) - (select count(*) from fct_tx_broken where is_settlement_eligible or"
        " (is_reversed and transaction_ref in (select transaction_ref from fct_stl_broken))))"
    )
    parts.append(
        "select 'mart_merchant_daily', 'ties_to_fact', abs((select cast(sum(attempts) as bigint)"
        " from daily_broken) - (select count(*) from fct_tx_broken))"
    )
    return " union all ".join(parts)


register(
    "c17_data_tests",
    lambda ws: ck.data_tests(
        {
            **_broken_tables(ws),
            "fct_transactions": fixtures.break_fct_transactions(ws.fct_tx),
            "fct_settlements": fixtures.break_fct_settlements(ws.fct_stl),
            "mart_merchant_daily": fixtures.break_success_rate(ws.daily),
            "mart_channel_performance": fixtures.break_success_rate(ws.channels),
        }
    ),
    sql(_tests_sql(), faulty=True),
    faulty=True,
)
register(
    "c18_daily_ties_to_fact",
    lambda ws: ck.daily_ties_to_fact(ws.daily, ws.fct_tx),
    sql(
        "select a as daily_attempts, b as fact_rows, a - b as difference from (select"
        " (select cast(sum(attempts) as bigint) from daily) as a,"
        " (select count(*) from fct_tx) as b)"
    ),
)
register(
    "c19_stale_but_missing",
    lambda ws: ck.stale_but_missing(fixtures.break_recon(ws.recon)),
    sql(
        "select transaction_ref, source_freshness_status, reconciliation_status from recon_broken"
        " where source_freshness_status = 'stale_or_incomplete'"
        " and reconciliation_status = 'missing_settlement'"
    ),
)


def _bags_of_events(ws):
    """Events by key against events by id: the same bag. Deliveries against a layer that lost
    some and doubled others: not."""
    raw = ws.raw_transactions()
    by_key = staging.dedupe_transactions(raw)
    by_id = raw.select("event_id").distinct()
    off = fixtures.lost_and_doubled(raw)
    return (
        ck.compare_bags(by_key, by_id, "event_id")
        .withColumn("bag", F.lit("events"))
        .unionByName(ck.compare_bags(raw, off, "event_id").withColumn("bag", F.lit("deliveries")))
    )


_BAGS = """
select bag, sum(e)::bigint as expected, sum(f)::bigint as found,
  sum(greatest(0, f - e))::bigint as extra, sum(greatest(0, e - f))::bigint as missing,
  bool_and(e = f) as exact
from (select bag, event_id, sum(e) as e, sum(f) as f from (
  select 'events' as bag, event_id, 1 as e, 0 as f from tx_once
  union all select distinct 'events', event_id, 0, 1 from tx_raw
  union all select 'deliveries', event_id, 1, 0 from tx_raw
  union all select 'deliveries', event_id, 0, 1 from tx_raw_off) group by 1, 2)
where e > 0 group by 1"""
register("c20_event_bag_exact", _bags_of_events, sql(_BAGS))
register(
    "c20_differing_ranges",
    lambda ws: fp.differing_ranges(
        ws.raw_transactions(), fixtures.lost_and_doubled(ws.raw_transactions()), "event_id"
    ),
    sql(
        "select range, sum(e)::bigint as expected, sum(f)::bigint as found from ("
        "select left(md5(event_id), 4) as range, event_id, sum(e) as e, sum(f) as f from ("
        "select event_id, 1 as e, 0 as f from tx_raw union all"
        " select event_id, 0, 1 from tx_raw_off) group by 1, 2)"
        " group by 1 having bool_or(e <> f)"
    ),
)
register(
    "u03_difference_by_ranges",
    lambda ws: fp.bag_difference_by_ranges(
        ws.raw_transactions(), fixtures.lost_and_doubled(ws.raw_transactions()), "event_id"
    ),
    sql(
        "select event_id, if(f > e, 'extra', 'missing') as side, abs(f - e)::bigint as copies from ("
        "select event_id, sum(e) as e, sum(f) as f from ("
        "select event_id, 1 as e, 0 as f from tx_raw union all"
        " select event_id, 0, 1 from tx_raw_off) group by 1) where e <> f"
    ),
)
_CHUNK = {
    "chunk": """
select 'nightly|n=1000000|days=14|seed=42|chunk=1000' as run_key,
  k // 1000 * 1000 as chunk_start, count(*) as transactions,
  count(*) filter (where final_status in ('success', 'reversed')) as settlements,
  1705298400 + k // 1000 * 1000 as committed_at from charge group by k // 1000""",
    "listed": "select * from chunk where chunk_start // 1000 % 3 <> 0",
    "listed_twice": """
select * from listed union all select * from listed where chunk_start // 1000 % 7 = 1""",
}
register(
    "c21_duplicate_ledger_rows",
    lambda ws: ck.duplicate_ledger_rows(fixtures.ledger(ws.chunks(), doubled=True)),
    sql(
        "select run_key, count(*) - count(distinct chunk_start) as duplicate_rows"
        " from listed_twice group by 1",
        extra=_CHUNK,
    ),
)
