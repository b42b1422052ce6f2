"""Queries on ingest, dedupe, collapse and the staged columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.functions import status_rank
from tallymark.operators import coerce as co
from tallymark.operators import staging as st
from tallymark.plans import fixtures
from tallymark.plans.queries.base import register
from tallymark.plans.sqltext import cols, sql
from tallymark.schemas import TRANSACTION_EVENT

TX_RAW = (
    "event_id event_ts:t transaction_ref merchant_id customer_id gateway channel bank_code status"
    " amount_kobo fee_kobo currency fx_rate_to_ngn failure_reason settlement_lag_days:i"
    " settlement_source_watermark_at:t created_at:t updated_at:t ingested_at:t"
)
STL_RAW = (
    "event_id event_ts:t settlement_id payout_id merchant_id transaction_ref gross_kobo fee_kobo"
    " net_kobo currency settlement_date:d settled_at:t ingested_at:t"
)
STG_TX = (
    "transaction_ref merchant_id customer_id gateway channel bank_code status currency"
    " failure_reason amount_kobo fee_kobo amount_ngn_kobo fee_ngn_kobo fx_rate_to_ngn created_at:t"
    " updated_at:t successful_at:t ingested_at:t event_date:d arrival_lag_seconds"
    " settlement_lag_days:i expected_settlement_date:d settlement_source_watermark_at:t is_terminal"
    " is_success is_reversed is_settlement_eligible"
)
STG_STL = (
    "settlement_id payout_id transaction_ref merchant_id gross_kobo fee_kobo net_kobo currency"
    " settlement_date:d settled_at:t ingested_at:t"
)

# --- Coercion and quarantine ---------------------------------------------------------

def _stamp():
    return F.timestamp_seconds(F.lit(fixtures.INGESTED))


CLASSIFIED = {
    "classified_messages": """
select n, payload, case when payload is null then 'TypeError'
  when not json_valid(payload) then 'JSONDecodeError'
  when json_type(payload) <> 'OBJECT' then 'AttributeError'
  when try_cast(json_extract_string(payload, '$.updated_at') as timestamptz) is null
    then 'ValueError'
  when json_type(payload, '$.amount_kobo') = 'VARCHAR' then 'SchemaMismatch'
  when json_type(payload, '$.merchant_id') is null then 'MissingRequired' end as error_type
from messages"""
}
GOOD = """
select {fields}, 1705298400 as ingested_at from classified_messages where error_type is null"""


def _text(name: str) -> str:
    return f"json_extract_string(payload, '$.{name}') as {name}"


def _number(name: str) -> str:
    return f"cast(json_extract_string(payload, '$.{name}') as bigint) as {name}"


def _epoch(name: str) -> str:
    return (
        f"cast(epoch(strptime(substr(json_extract_string(payload, '$.{name}'), 1, 19),"
        f" '%Y-%m-%dT%H:%M:%S')) as bigint) as {name}"
    )


_STRINGS = (
    "event_id transaction_ref merchant_id customer_id gateway channel bank_code status currency"
    " failure_reason"
).split()
_NUMBERS = "amount_kobo fee_kobo settlement_lag_days".split()
_TIMES = "event_ts settlement_source_watermark_at created_at updated_at".split()
_FIELDS = ", ".join(
    [_text(f) for f in _STRINGS]
    + [_number(f) for f in _NUMBERS]
    + [_epoch(f) for f in _TIMES]
    + ["cast(json_extract_string(payload, '$.fx_rate_to_ngn') as double) as fx_rate_to_ngn"]
)


def _coerced(ws):
    return co.coerce(ws.messages(), TRANSACTION_EVENT)


register(
    "v02_coerced_records",
    lambda ws: co.accepted(_coerced(ws), TRANSACTION_EVENT, _stamp()),
    sql(GOOD.format(fields=_FIELDS), extra=CLASSIFIED),
)
register(
    "v03_parsed_times",
    lambda ws: co.accepted(_coerced(ws), TRANSACTION_EVENT, _stamp()).select(
        "event_id", "event_ts", "created_at", "updated_at", "settlement_source_watermark_at"
    ),
    sql(
        "select "
        + ", ".join([_text("event_id"), *[_epoch(f) for f in _TIMES]])
        + " from classified_messages where error_type is null",
        extra=CLASSIFIED,
    ),
)
register(
    "v04_good_and_malformed",
    lambda ws: _coerced(ws)
    .groupBy(F.coalesce("error_type", F.lit("none")).alias("error_type"))
    .agg(F.count("*").alias("messages")),
    sql(
        "select coalesce(error_type, 'none') as error_type, count(*) as messages"
        " from classified_messages group by 1",
        extra=CLASSIFIED,
    ),
)
register(
    "v05_quarantine",
    lambda ws: co.quarantined(_coerced(ws), _stamp()),
    sql(
        "select 'transactions' as source_topic, 1705298400 as ingested_at, error_type,"
        " left(coalesce(payload, ''), 256000) as raw_payload,"
        " length(coalesce(payload, '')) > 256000 as payload_truncated"
        " from classified_messages where error_type is not null",
        extra=CLASSIFIED,
    ),
)
register(
    "v06_empty_payloads",
    lambda ws: co.quarantined(_coerced(ws), _stamp())
    .where(F.col("raw_payload") == "")
    .groupBy("error_type", "raw_payload", "payload_truncated")
    .agg(F.count("*").alias("messages")),
    sql(
        "select error_type, coalesce(payload, '') as raw_payload, false as payload_truncated,"
        " count(*) as messages from classified_messages where coalesce(payload, '') = ''"
        " group by 1, 2",
        extra=CLASSIFIED,
    ),
)
register(
    "v07_ingest_stamp",
    lambda ws: co.accepted(_coerced(ws), TRANSACTION_EVENT, _stamp())
    .groupBy("ingested_at")
    .agg(F.count("*").alias("written")),
    sql(
        "select 1705298400 as ingested_at, count(*) as written from classified_messages"
        " where error_type is null",
        extra=CLASSIFIED,
    ),
)
register(
    "v08_drain_counts",
    lambda ws: co.drain_counts(_coerced(ws)),
    sql(
        "select count(*) as consumed, count(*) filter (where error_type is null) as written,"
        " count(*) filter (where error_type is not null) as malformed from classified_messages",
        extra=CLASSIFIED,
    ),
)

# --- Dedupe and collapse -------------------------------------------------------------

register(
    "d01_dedupe_transactions",
    lambda ws: st.dedupe_transactions(ws.raw_transactions()),
    sql(f"select {cols(TX_RAW)} from tx_dedup"),
)
register(
    "d02_status_rank",
    lambda ws: ws.raw_transactions()
    .groupBy("status", status_rank(F.col("status")).alias("status_rank"))
    .agg(F.count("*").alias("raw_events")),
    sql(
        "select status, cast(case status when 'pending' then 0 when 'failed' then 1"
        " when 'success' then 2 when 'reversed' then 3 end as bigint) as status_rank,"
        " count(*) as raw_events from tx_raw group by 1, 2"
    ),
)
register(
    "d03_successful_at",
    lambda ws: st.latest_status(st.dedupe_transactions(ws.raw_transactions())).select(
        "transaction_ref", "status", "successful_at"
    ),
    sql(f"select {cols('transaction_ref status successful_at:t')} from tx_latest"),
)
register(
    "d04_latest_status",
    lambda ws: st.latest_status(st.dedupe_transactions(ws.raw_transactions())).select(
        "transaction_ref", "event_id", "status", "updated_at", "failure_reason"
    ),
    sql(
        f"select {cols('transaction_ref event_id status updated_at:t failure_reason')}"
        " from tx_latest",
        faulty=True,
    ),
    faulty=True,
)
register(
    "d05_ngn_kobo",
    lambda ws: st.derive(st.latest_status(st.dedupe_transactions(ws.raw_transactions()))).select(
        "transaction_ref", "currency", "fx_rate_to_ngn", "amount_ngn_kobo", "fee_ngn_kobo"
    ),
    sql(
        "select transaction_ref, currency, fx_rate_to_ngn, amount_ngn_kobo, fee_ngn_kobo"
        " from stg_tx",
        faulty=True,
    ),
    faulty=True,
)
for _key, _columns, _spec in (
    ("d06_arrival_lag", ("transaction_ref", "arrival_lag_seconds"), None),
    ("d07_is_terminal", ("transaction_ref", "status", "is_terminal"), None),
    ("d08_event_date", ("transaction_ref", "event_date"), "transaction_ref event_date:d"),
    (
        "d09_expected_settlement_date",
        ("transaction_ref", "expected_settlement_date"),
        "transaction_ref expected_settlement_date:d",
    ),
):
    register(
        _key,
        lambda ws, c=_columns: st.derive(
            st.latest_status(st.dedupe_transactions(ws.raw_transactions()))
        ).select(*c),
        sql(f"select {cols(_spec or ' '.join(_columns))} from stg_tx"),
    )
register(
    "d11_transform_metrics",
    lambda ws: st.transaction_metrics(ws.raw_transactions()),
    sql("""
select raw_events, after_dedupe, raw_events - after_dedupe as duplicates_removed,
  transactions_out, after_dedupe - transactions_out as events_collapsed
from (select (select count(*) from tx_raw) as raw_events,
  (select count(*) from tx_dedup) as after_dedupe,
  (select count(*) from tx_latest) as transactions_out)"""),
)
register(
    "d11_settlement_metrics",
    lambda ws: st.settlement_metrics(ws.raw_settlements()),
    sql("""
select raw_events, settlements_out, raw_events - settlements_out as duplicates_removed
from (select (select count(*) from stl_raw) as raw_events,
  (select count(*) from stg_stl) as settlements_out)"""),
)
register(
    "d12_dedupe_settlements",
    lambda ws: st.dedupe_settlements(ws.raw_settlements()),
    sql(
        f"select {cols(STL_RAW)} from stl_raw qualify row_number() over (partition by"
        " settlement_id, transaction_ref order by ingested_at, event_ts) = 1",
        faulty=True,
    ),
    faulty=True,
)
register(
    "d14_stg_transactions",
    lambda ws: ws.stg_transactions(),
    sql(f"select {cols(STG_TX)} from stg_tx"),
)
register(
    "d15_flags",
    lambda ws: ws.stg_transactions().select(
        "transaction_ref", "status", "is_success", "is_reversed", "is_settlement_eligible"
    ),
    sql(
        "select transaction_ref, status, is_success, is_reversed, is_settlement_eligible"
        " from stg_tx"
    ),
)
register(
    "d16_stg_settlements",
    lambda ws: ws.stg_settlements(),
    sql(f"select {cols(STG_STL)} from stg_stl"),
)
register(
    "w01_winner_per_ref",
    lambda ws: st.latest_status(st.dedupe_transactions(ws.raw_transactions())).select(
        "transaction_ref", "event_id"
    ),
    sql("select transaction_ref, event_id from tx_latest"),
)
register(
    "w02_success_over_all_events",
    lambda ws: st.latest_status(st.dedupe_transactions(ws.raw_transactions()))
    .where(F.col("status") == "reversed")
    .select("transaction_ref", "successful_at"),
    sql(
        f"select {cols('transaction_ref successful_at:t')} from tx_latest"
        " where status = 'reversed'"
    ),
)
register(
    "r03_event_time_beats_arrival",
    lambda ws: st.latest_status(st.dedupe_transactions(ws.raw_transactions()))
    .groupBy("status")
    .agg(F.count("*").alias("transactions"), F.max("ingested_at").alias("last_arrival")),
    sql(
        "select status, count(*) as transactions,"
        " cast(epoch(max(ingested_at)) as bigint) as last_arrival from tx_latest group by 1",
        faulty=True,
    ),
    faulty=True,
)
