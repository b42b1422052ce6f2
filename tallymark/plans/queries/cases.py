"""Queries on cases, analyst actions, the queue and the chunk ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.operators import cases as cs
from tallymark.operators import checks as ck
from tallymark.operators import ledger as lg
from tallymark.operators.actions import STATES, next_statuses
from tallymark.plans import fixtures
from tallymark.plans.queries.base import register
from tallymark.plans.queries.quality import _CHUNK
from tallymark.plans.sqltext import cols, sql

_REFUSED = """case
  when case_id not in (select case_id from breaks_one) and length(case_id) <> 64
    then 'case_not_found'
  when length(idempotency_key) < 8 then 'invalid_key'
  when trim(analyst) = '' then 'analyst_required'
  when case_id not in (select case_id from breaks_one) then 'case_not_found' end"""
_RUN_ONE, _RUN_TWO = 1705298400 + 86_400, 1705298400 + 2 * 86_400

# A strictly sequential run over the log, one request per step.
_EXTRA = {
    "numbered": f"""
select *, row_number() over (order by action_id) as i, {_REFUSED} as refused,
  action in ('ESCALATE', 'CLOSE', 'REOPEN') and trim(notes) = '' as note_missing from requests""",
    "stepped": """
select cast(0 as bigint) as i, map([]::bigint[], []::varchar[]) as states,
  map([]::varchar[], []::bigint[]) as used, null::varchar as outcome, null::varchar as target,
  null::bigint as replay_of
union all
select i, case when outcome = 'accepted' then map_concat(states, map([k], [next_status]))
    else states end,
  case when outcome = 'accepted' then map_concat(used, map([idempotency_key], [action_id]))
    else used end,
  outcome, case when outcome = 'accepted' then next_status end,
  case when outcome = 'replayed' then owner_id end
from (
  select l.i, f.states, f.used, l.k, l.idempotency_key, l.action_id, m.next_status,
    o.action_id as owner_id,
    case when l.refused is not null then l.refused
      when o.action_id is not null and o.case_id = l.case_id and o.action = l.action
        then 'replayed'
      when o.action_id is not null then 'conflict'
      when l.note_missing then 'missing_note'
      when m.next_status is null then 'invalid_transition' else 'accepted' end as outcome
  from stepped f join numbered l on l.i = f.i + 1
  left join moves m on m.action = l.action
    and m.current_status = coalesce(f.states[l.k], 'UNTOUCHED')
  left join numbered o on o.action_id = f.used[l.idempotency_key])""",
    "outcomes": """
select l.action_id, l.case_id, l.action, l.idempotency_key, s.outcome,
  nullif(s.target, 'UNTOUCHED') as resulting_status, s.replay_of, s.target, l.k
from stepped s join numbered l on l.i = s.i""",
    "decided": """
select case_id, arg_max(target, action_id) as target from outcomes where outcome = 'accepted'
group by 1""",
    "cases_one": f"""
select *, 'CASE-' || upper(substr(case_id, 1, 16)) as display_id, 'OPEN' as system_status,
  break_type || ':' || exposure_kobo as system_fingerprint from breaks_one""",
    "cases_decided": """
select c.*, nullif(d.target, 'UNTOUCHED') as analyst_status,
  case when d.target <> 'UNTOUCHED' then c.system_fingerprint end as decided_fingerprint
from cases_one c left join decided d on c.case_id = d.case_id""",
    "cases_two": f"""
select coalesce(n.case_id, o.case_id) as case_id,
  'CASE-' || upper(substr(coalesce(n.case_id, o.case_id), 1, 16)) as display_id,
  coalesce(o.transaction_ref, n.transaction_ref) as transaction_ref,
  coalesce(o.merchant_id, n.merchant_id) as merchant_id,
  coalesce(o.channel, n.channel) as channel, coalesce(o.gateway, n.gateway) as gateway,
  case when o.case_id is not null then o.bank_code else n.bank_code end as bank_code,
  coalesce(o.currency, n.currency) as currency,
  coalesce(o.succeeded_date, n.succeeded_date) as succeeded_date,
  coalesce(n.amount_ngn_kobo, o.amount_ngn_kobo) as amount_ngn_kobo,
  coalesce(n.expected_net_kobo, o.expected_net_kobo) as expected_net_kobo,
  case when n.case_id is not null then n.settled_net_kobo else o.settled_net_kobo end
    as settled_net_kobo,
  coalesce(n.break_type, o.break_type) as break_type,
  coalesce(n.exposure_kobo, o.exposure_kobo) as exposure_kobo,
  case when n.case_id is not null then 'OPEN' else 'CLEARED' end as system_status,
  coalesce(n.break_type || ':' || n.exposure_kobo, o.system_fingerprint) as system_fingerprint,
  o.analyst_status, o.decided_fingerprint,
  case when o.case_id is not null then {_RUN_ONE} else {_RUN_TWO} end as first_seen_at,
  case when n.case_id is not null then {_RUN_TWO} else {_RUN_ONE} end as last_seen_at,
  {_RUN_TWO} as updated_at, coalesce(o.k, n.k) as k
from cases_decided o full join breaks_two n on o.case_id = n.case_id""",
    "effective": """
select *, coalesce(analyst_status, system_status) as effective_status,
  coalesce(analyst_status in ('CLOSED', 'EXPECTED_DELAY')
    and decided_fingerprint <> system_fingerprint, false) as drifted from cases_two""",
}
_ACTIVE = "(effective_status not in ('CLOSED', 'CLEARED') or drifted)"
CASE = (
    "case_id display_id transaction_ref merchant_id channel gateway bank_code currency"
    " succeeded_date:d amount_ngn_kobo expected_net_kobo settled_net_kobo break_type exposure_kobo"
    " system_status system_fingerprint analyst_status decided_fingerprint first_seen_at"
    " last_seen_at updated_at"
)


def _sql(final: str) -> str:
    return sql(final, extra=_EXTRA)


register(
    "k01_break_feed",
    lambda ws: cs.break_feed(ws.recon),
    sql(
        "select case_id, transaction_ref, merchant_id, channel, gateway, bank_code, currency,"
        " cast(succeeded_date as varchar) as succeeded_date, amount_ngn_kobo, expected_net_kobo,"
        " settled_net_kobo, break_type, exposure_kobo from breaks"
    ),
)
register(
    "k03_second_sync",
    lambda ws: cs.sync_cases(
        ws.applied().cases, fixtures.second_breaks(ws.recon), _stamp(ws)
    ),
    _sql(f"select {cols(CASE)} from cases_two"),
)
register(
    "k03_sync_counts",
    lambda ws: cs.sync_counts(ws.applied().cases, fixtures.second_breaks(ws.recon)).drop("repeated"),
    _sql(
        "select (select count(*) from breaks_two) as current_breaks, (select count(*) from"
        " breaks_one where case_id not in (select case_id from breaks_two)) as newly_cleared"
    ),
)
register(
    "k04_seen_stamps",
    lambda ws: ws.second_cases().select("case_id", "first_seen_at", "last_seen_at"),
    _sql("select case_id, first_seen_at, last_seen_at from cases_two"),
)
register(
    "j07_cleared_cases",
    lambda ws: ws.second_cases().where(F.col("system_status") == "CLEARED").select("case_id"),
    _sql("select case_id from breaks_one where case_id not in (select case_id from breaks_two)"),
)
register(
    "j09_merge_columns_by_owner",
    lambda ws: ws.second_cases().select(
        "case_id", "system_status", "system_fingerprint", "analyst_status", "decided_fingerprint"
    ),
    _sql(
        "select case_id, system_status, system_fingerprint, analyst_status, decided_fingerprint"
        " from cases_two"
    ),
)
register(
    "k05_effective_cases",
    lambda ws: ws.effective().select(
        "case_id", "system_status", "analyst_status", "effective_status", "drifted"
    ),
    _sql("select case_id, system_status, analyst_status, effective_status, drifted from effective"),
)
register(
    "k06_queue_views",
    lambda ws: cs.view_counts(ws.effective()),
    _sql(
        f"select 'active' as queue_view, count(*) filter (where {_ACTIVE}) as cases"
        " from effective union all select 'closed', count(*) filter (where"
        " effective_status = 'CLOSED' and not drifted) from effective union all"
        " select 'cleared', count(*) filter (where effective_status = 'CLEARED') from effective"
        " union all select 'all', count(*) from effective"
    ),
)
register(
    "k07_transitions",
    lambda ws: next_statuses(
        ws.requests().select(
            "action_id",
            "action",
            F.array(*[F.lit(s) for s in STATES])[
                (F.call_function("div", F.col("action_id"), F.lit(10)) % 5).cast("int")
            ].alias("current_status"),
        ),
        "current_status",
        "action",
    ),
    sql("""
select r.action_id, r.action, r.current_status, m.next_status, m.next_status is not null
  as is_legal
from (select action_id, action, ['UNTOUCHED', 'MANUAL_REVIEW', 'ESCALATED', 'EXPECTED_DELAY',
  'CLOSED'][action_id // 10 % 5 + 1] as current_status from requests) r
left join moves m on m.current_status = r.current_status and m.action = r.action"""),
)
register(
    "k08_apply_actions",
    lambda ws: ws.applied().outcomes,
    _sql(
        "select action_id, case_id, action, idempotency_key, outcome, resulting_status, replay_of"
        " from outcomes"
    ),
)
register(
    "k09_replays_and_conflicts",
    lambda ws: ws.applied()
    .outcomes.where(F.col("outcome").isin("replayed", "conflict"))
    .select("action_id", "idempotency_key", "outcome", "replay_of"),
    _sql(
        "select action_id, idempotency_key, outcome, replay_of from outcomes"
        " where outcome in ('replayed', 'conflict')"
    ),
)
register(
    "k10_decisions",
    lambda ws: ws.applied().cases.select("case_id", "analyst_status", "decided_fingerprint"),
    _sql("select case_id, analyst_status, decided_fingerprint from cases_decided"),
)
register(
    "k12_case_constraints",
    lambda ws: ck.case_constraint_violations(fixtures.break_cases(ws.second_cases())),
    _sql("""
select case when k % 7 = 6 then upper(case_id) else case_id end as case_id, constraint_name
from cases_two join (values (1, 'exposure_not_negative'), (2, 'amount_not_negative'),
  (3, 'break_type_known'), (4, 'system_status_known'), (5, 'analyst_status_known'),
  (6, 'case_id_format')) v(slot, constraint_name) on k % 7 = slot
union all select case_id, 'decision_has_fingerprint' from cases_two
where k % 7 = 5 and decided_fingerprint is null"""),
)


def _broken_keys(ws):
    """Cases without required fields, and some rows twice."""
    cases = ws.second_cases()
    number = F.substring("transaction_ref", 4, 10).cast("bigint")
    return cases.withColumns(
        {
            "merchant_id": F.when(number % 11 != 3, F.col("merchant_id")),
            "display_id": F.when(number % 11 != 4, F.col("display_id")),
            "exposure_kobo": F.when(number % 11 != 5, F.col("exposure_kobo")),
        }
    ).unionByName(cases.where(number % 13 == 6))


register(
    "k12_required_fields",
    lambda ws: ck.case_constraint_violations(_broken_keys(ws)),
    _sql("""
select case_id, constraint_name from cases_two join (values (3, 'merchant_id_present'),
  (4, 'display_id_present'), (5, 'exposure_kobo_present')) v(slot, constraint_name)
  on cast(substr(transaction_ref, 4, 10) as bigint) % 11 = slot"""),
)
register(
    "k12_unique_keys",
    lambda ws: ck.case_key_violations(_broken_keys(ws)),
    _sql("""
select key_name, key_value, 2::bigint as copies from (
  select *, cast(substr(transaction_ref, 4, 10) as bigint) as n from cases_two) c,
  lateral (values ('case_id', c.case_id), ('transaction_ref', c.transaction_ref),
    ('display_id', if(c.n % 11 = 4, null, c.display_id))) v(key_name, key_value)
where n % 13 = 6 and key_value is not null"""),
)
register(
    "k12_action_keys",
    lambda ws: ck.action_key_violations(ws.requests(), ws.second_cases()),
    _sql("""
select distinct 'action_has_case' as constraint_name, case_id as key_value from requests
  where case_id not in (select case_id from cases_two)
union all select 'idempotency_key_unique', idempotency_key from requests
  group by 2 having count(*) > 1"""),
)
register(
    "k12_action_constraints",
    lambda ws: ck.action_constraint_violations(ws.requests()),
    sql(
        "select action_id, 'analyst_present' as constraint_name from requests"
        " where trim(analyst) = '' union all select action_id, 'key_length' from requests"
        " where length(idempotency_key) < 8"
    ),
)
register(
    "a25_active_summary",
    lambda ws: cs.active_summary(ws.effective()),
    _sql(
        "select break_type, count(*) as cases, cast(sum(exposure_kobo) as bigint)"
        f" as exposure_kobo from effective where {_ACTIVE} group by 1"
    ),
)
register(
    "a25_queue_summary",
    lambda ws: cs.queue_summary(ws.effective()),
    _sql(
        f"select count(*) filter (where {_ACTIVE}) as active_cases,"
        f" cast(sum(exposure_kobo) filter (where {_ACTIVE}) as bigint) as active_exposure_kobo,"
        " count(*) filter (where drifted) as drifted_cases from effective"
    ),
)
_PAGE = "case_id display_id break_type exposure_kobo succeeded_date:d effective_status drifted"
_PAGE_NAMES = [c.partition(":")[0] for c in _PAGE.split()]
_ORDER = "order by exposure_kobo desc, effective.succeeded_date, case_id"
register(
    "l04_queue_page",
    lambda ws: cs.queue_page(ws.effective(), "active", limit=25, offset=10).select(*_PAGE_NAMES),
    _sql(f"select {cols(_PAGE)} from effective where {_ACTIVE} {_ORDER} limit 25 offset 10"),
)
register(
    "l04_queue_page_of_type",
    lambda ws: cs.queue_page(ws.effective(), "active", "short_paid", limit=25).select(
        *_PAGE_NAMES
    ),
    _sql(
        f"select {cols(_PAGE)} from effective where {_ACTIVE} and break_type = 'short_paid'"
        f" {_ORDER} limit 25"
    ),
)


def _after(ws):
    """Rows 11 to 35 of the queue, asked for by the cursor of row 10."""
    queue = ws.queue()
    last = queue.page("active", limit=10).collect()[-1]
    return queue.page("active", limit=25, after=tuple(last[c] for c in cs.QUEUE_ORDER))


register(
    "l04_page_after_cursor",
    lambda ws: _after(ws).select(*_PAGE_NAMES),
    _sql(f"select {cols(_PAGE)} from effective where {_ACTIVE} {_ORDER} limit 25 offset 10"),
)
register(
    "l04_queue_total",
    lambda ws: cs.queue_total(ws.effective(), "active", "short_paid"),
    _sql(
        f"select count(*) as total from effective where {_ACTIVE} and break_type = 'short_paid'"
    ),
)


def _escalated(ws):
    return (
        ws.effective()
        .where(F.col("analyst_status") == "ESCALATED")
        .agg(F.min_by("case_id", "transaction_ref").alias("case_id"))
        .scalar()
    )


register(
    "l05_case_with_actions",
    lambda ws: cs.case_with_actions(
        ws.effective(), ws.applied().recorded, _escalated(ws)
    ).select("case_id", "effective_status", "action_id", "action", "resulting_status"),
    _sql("""
select e.case_id, e.effective_status, o.action_id, o.action, o.resulting_status
from effective e left join (select * from outcomes where outcome = 'accepted') o
  on o.case_id = e.case_id
where e.case_id = (select arg_min(case_id, transaction_ref) from effective
  where analyst_status = 'ESCALATED')"""),
)

# --- Chunk ledger ---------------------------------------------------------------------

register(
    "r08_pending_chunks",
    lambda ws: lg.pending_chunks(ws.chunks(), fixtures.ledger(ws.chunks())).select(
        "run_key", "chunk_start", "transactions"
    ),
    sql(
        "select run_key, chunk_start, transactions from chunk where chunk_start // 1000 % 3 = 0",
        extra=_CHUNK,
    ),
)
register(
    "r08_record_chunks",
    lambda ws: lg.record_chunks(fixtures.ledger(ws.chunks()), ws.chunks()),
    sql(
        "select run_key, chunk_start, transactions, settlements, committed_at from chunk",
        extra=_CHUNK,
    ),
)


def _stamp(ws):
    from tallymark.plans.workspace import run_stamp

    return run_stamp(2)
