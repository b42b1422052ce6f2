"""Queries of the column helpers, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark import functions as fn
from tallymark.plans import fixtures
from tallymark.plans.queries.base import register
from tallymark.plans.queries.cases import _EXTRA
from tallymark.plans.sqltext import sql

_C = F.col

register(
    "x01_naira",
    lambda ws: ws.fct_tx.select(
        "transaction_ref", fn.naira(_C("amount_ngn_kobo")).alias("amount_ngn")
    ),
    sql("select transaction_ref, amount_ngn_kobo / 100 as amount_ngn from fct_tx"),
)
register(
    "x02_naira_text",
    lambda ws: ws.recon.where(_C("is_settled")).select(
        "transaction_ref",
        fn.format_naira(_C("expected_net_kobo")).alias("expected_text"),
        fn.format_naira(_C("settlement_variance_kobo")).alias("variance_text"),
    ),
    sql(
        "select transaction_ref, {0} as expected_text, {1} as variance_text"
        " from recon where is_settled".format(
            *[
                f"case when {c} < 0 then '-' else '' end || format('{{:,}}', abs({c}) // 100)"
                f" || '.' || lpad(cast(abs({c}) % 100 as varchar), 2, '0')"
                for c in ("expected_net_kobo", "settlement_variance_kobo")
            ]
        )
    ),
)
register(
    "x03_display_id",
    lambda ws: ws.recon.select("case_id", fn.display_id(_C("case_id")).alias("display_id")),
    sql("select case_id, 'CASE-' || upper(substr(case_id, 1, 16)) as display_id from recon"),
)
register(
    "x04_fingerprint",
    lambda ws: ws.recon.where(_C("is_break")).select(
        "case_id", fn.fingerprint(_C("break_type"), _C("exposure_kobo")).alias("fingerprint")
    ),
    sql("select case_id, break_type || ':' || exposure_kobo as fingerprint from breaks"),
)
register(
    "x05_effective_status",
    lambda ws: ws.second_cases().select(
        "case_id",
        fn.effective_status(_C("analyst_status"), _C("system_status")).alias("effective_status"),
    ),
    sql(
        "select case_id, coalesce(analyst_status, system_status) as effective_status"
        " from cases_two",
        extra=_EXTRA,
    ),
)
register(
    "x06_drift",
    lambda ws: ws.second_cases().select(
        "case_id",
        fn.drifted(
            _C("analyst_status"), _C("decided_fingerprint"), _C("system_fingerprint")
        ).alias("drifted"),
    ),
    sql("select case_id, drifted from effective", extra=_EXTRA),
)
register(
    "x07_day_difference",
    lambda ws: ws.fct_stl.select(
        "settlement_id",
        F.datediff("settlement_date", F.to_date("transaction_created_at"))
        .cast("bigint")
        .alias("days"),
    ),
    sql(
        "select settlement_id, date_diff('day', cast(transaction_created_at as date),"
        " settlement_date) as days from fct_stl"
    ),
)
register(
    "x08_bank_or_na",
    lambda ws: ws.fct_tx.groupBy(F.coalesce("bank_code", F.lit("n/a")).alias("bank")).agg(
        F.count("*").alias("transactions")
    ),
    sql("select coalesce(bank_code, 'n/a') as bank, count(*) as transactions from fct_tx group by 1"),
)
register(
    "x09_fee_schedule",
    lambda ws: ws.charges().select(
        "transaction_ref",
        "channel",
        "amount_kobo",
        fn.fee_kobo(_C("amount_kobo"), _C("channel")).alias("fee_kobo"),
        fn.fee_kobo(
            F.call_function("div", _C("amount_kobo"), F.lit(100)), _C("channel")
        ).alias("fee_of_small_amount"),
    ),
    sql("""
select transaction_ref, channel, amount_kobo, {0} as fee_kobo, {1} as fee_of_small_amount
from charge""".format(
        *[
            "case when channel = 'bank_transfer'"
            f" then least(greatest({a} * 5 // 1000, 5000), 100000)"
            f" else least({a} * 15 // 1000 + case when {a} > 250000 then 10000 else 0 end, 200000)"
            " end"
            for a in ("amount_kobo", "(amount_kobo // 100)")
        ]
    )),
)
register(
    "x10_payout_id",
    lambda ws: ws.fct_stl.select(
        "settlement_id",
        fn.payout_id(_C("merchant_id"), _C("settlement_date")).alias("payout_id"),
    ),
    sql(
        "select settlement_id, 'PYO_' || merchant_id || '_' || strftime(settlement_date, '%Y%m%d')"
        " as payout_id from fct_stl"
    ),
)
register(
    "x11_format_checks",
    lambda ws: ws.requests().select(
        "action_id",
        fn.valid_case_id(_C("case_id")).alias("good_case_id"),
        fn.valid_case_id(F.upper("case_id")).alias("good_upper_case_id"),
        fn.valid_idempotency_key(_C("idempotency_key")).alias("good_key"),
        fn.valid_idempotency_key(F.concat("idempotency_key", F.lit(" "))).alias("good_key_blank"),
    ),
    sql(
        "select action_id, regexp_full_match(case_id, '[0-9a-f]{64}') as good_case_id,"
        " regexp_full_match(upper(case_id), '[0-9a-f]{64}') as good_upper_case_id,"
        " regexp_full_match(idempotency_key, '[A-Za-z0-9._:-]{8,128}') as good_key,"
        " false as good_key_blank from requests"
    ),
)
register(
    "x12_note_trimming",
    lambda ws: ws.requests().select("action_id", fn.cleaned_note(_C("notes")).alias("note")),
    sql("select action_id, nullif(trim(notes), '') as note from requests"),
)
register(
    "x13_run_key",
    lambda ws: fixtures.run_keys(ws.charges()),
    sql("""
select transaction_ref, run_key,
  'settlement-generator-' || substr(sha256(run_key), 1, 24) as publisher_id
from (select transaction_ref, merchant_id || '|n=' || k || '|days=' || settlement_lag_days
  || '|seed=' || (k % 100) || '|chunk=50000' as run_key from charge)"""),
)
register(
    "x14_built_in_functions",
    lambda ws: ws.recon.where(_C("is_settled")).select(
        "transaction_ref",
        F.abs("settlement_variance_kobo").alias("size"),
        F.greatest(F.lit(0).cast("bigint"), -_C("settlement_variance_kobo")).alias("short_by"),
        F.least(_C("expected_net_kobo"), _C("settled_net_kobo")).alias("covered"),
        F.length("case_id").cast("bigint").alias("id_length"),
        fn.round_to(_C("expected_net_kobo") / F.lit(1e6), 2).alias("millions"),
    ),
    sql(
        "select transaction_ref, abs(settlement_variance_kobo) as size,"
        " greatest(0, -settlement_variance_kobo) as short_by,"
        " least(expected_net_kobo, settled_net_kobo) as covered, length(case_id) as id_length,"
        " round(expected_net_kobo / 1e6, 2) as millions from recon where is_settled"
    ),
)
