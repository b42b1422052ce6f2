"""Staging against a plain-Python recomputation, and its behaviour on odd input."""

from collections import Counter, defaultdict
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallymark.operators import staging as st
from tallymark.plans import fixtures
from tallymark.plans.nightly import stage
from tallymark.schemas import STATUS_RANK, TRANSACTION_EVENT, nullable
from tallymark.sources.tables import read_staged

T0 = datetime(2024, 1, 1, tzinfo=UTC)


def event(ref="t1", event_id="e1", status="pending", at=0, arrived=0, **over):
    row = {
        "event_id": event_id,
        "event_ts": T0 + timedelta(seconds=at),
        "transaction_ref": ref,
        "merchant_id": "m",
        "customer_id": "c",
        "gateway": "g",
        "channel": "card",
        "bank_code": None,
        "status": status,
        "amount_kobo": 1000,
        "fee_kobo": 15,
        "currency": "NGN",
        "fx_rate_to_ngn": None,
        "failure_reason": None,
        "settlement_lag_days": 1,
        "settlement_source_watermark_at": T0,
        "created_at": T0,
        "updated_at": T0 + timedelta(seconds=at),
        "ingested_at": T0 + timedelta(days=1, seconds=arrived),
    }
    row.update(over)
    return tuple(row[c] for c in TRANSACTION_EVENT.names)


def frame(spark, rows):
    return spark.createDataFrame(rows, nullable(TRANSACTION_EVENT))


def test_winner_and_success_match_an_independent_recomputation(faulty):
    raw = faulty.raw_transactions()
    events = raw.select(
        "transaction_ref", "event_id", "status",
        F.unix_timestamp("updated_at").alias("at"), F.unix_timestamp("ingested_at").alias("arrived"),
    ).collect()
    first = {}
    for e in sorted(events, key=lambda e: e["arrived"]):
        first.setdefault((e["transaction_ref"], e["event_id"]), e)
    by_ref = defaultdict(list)
    for e in first.values():
        by_ref[e["transaction_ref"]].append(e)
    want = {}
    for ref, group in by_ref.items():
        last = max(group, key=lambda e: (e["at"], STATUS_RANK[e["status"]], e["event_id"]))
        success = [e["at"] for e in group if e["status"] == "success"]
        want[ref] = (last["event_id"], last["status"], last["arrived"], max(success, default=None))
    got = st.latest_status(st.dedupe_transactions(raw)).select(
        "transaction_ref", "event_id", "status",
        F.unix_timestamp("ingested_at"), F.unix_timestamp("successful_at"),
    )
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert len(first) < len(events)  # there were duplicates to remove


def test_published_fixture_counts(base):
    assert base.raw_transactions().count() == 3072
    assert base.raw_settlements().count() == 5358
    assert base.stg_settlements().count() == 1313
    got = {r[0]: r[1] for r in base.stg_transactions().groupBy("status").count().collect()}
    assert got == {"success": 1360, "failed": 120, "reversed": 16, "pending": 4}


def test_order_of_arrival_does_not_matter(spark):
    late_pending = [
        event(event_id="e2", status="success", at=10, arrived=0),
        event(event_id="e1", status="pending", at=0, arrived=99),
    ]
    row = st.latest_status(st.dedupe_transactions(frame(spark, late_pending))).first()
    assert row["status"] == "success"


@pytest.mark.parametrize("statuses", [("pending", "failed"), ("success", "reversed")])
def test_same_instant_is_decided_by_rank(spark, statuses):
    low, high = statuses
    rows = [event(event_id="z", status=low), event(event_id="a", status=high)]
    assert st.latest_status(frame(spark, rows)).first()["status"] == high


def test_unknown_status_ranks_last(spark):
    rows = [event(event_id="z", status="lost"), event(event_id="a", status="pending")]
    assert st.latest_status(frame(spark, rows)).first()["status"] == "pending"


def test_first_delivery_survives(spark):
    rows = [event(arrived=60), event(arrived=0), event(arrived=30)]
    kept = st.dedupe_transactions(frame(spark, rows)).collect()
    assert len(kept) == 1 and kept[0]["ingested_at"].second == 0


def test_reversal_keeps_the_success_date_and_moves_past_midnight(spark):
    rows = [
        event(event_id="a", status="success", at=86_400 + 5),
        event(event_id="b", status="reversed", at=3 * 86_400),
    ]
    row = st.derive(st.latest_status(frame(spark, rows))).first()
    assert str(row["expected_settlement_date"]) == "2024-01-03"
    assert str(row["event_date"]) == "2024-01-01"


def test_dollars_truncate_and_a_missing_rate_gives_zero(spark):
    rows = [
        event("a", currency="USD", amount_kobo=3, fee_kobo=1, fx_rate_to_ngn=1.99),
        event("b", currency="USD", amount_kobo=3),
        event("c", amount_kobo=7),
    ]
    staged = st.derive(st.latest_status(frame(spark, rows)))
    got = {r["transaction_ref"]: (r["amount_ngn_kobo"], r["fee_ngn_kobo"]) for r in staged.collect()}
    assert got == {"a": (5, 1), "b": (0, 0), "c": (7, 15)}


def test_result_does_not_depend_on_partitioning(base):
    raw = base.raw_transactions()
    one = st.stage_transactions(raw.coalesce(1)).drop("processed_at")
    many = st.stage_transactions(raw.repartition(7)).drop("processed_at")
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_a_key_with_most_of_the_rows_is_reduced_before_the_shuffle(spark):
    """Each map task may send one row per key, so both aggregates must have a partial side."""
    plan = st.stage_transactions(frame(spark, [event()]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_min") == 1 and text.count("partial_max") >= 1
    assert "Window" not in text
    copies = [event("hot", "e1", arrived=i) for i in range(500)]
    history = [event("hot", f"h{i}", status="failed", at=i) for i in range(500)]
    row = st.latest_status(st.dedupe_transactions(frame(spark, copies + history))).collect()
    assert len(row) == 1 and row[0]["event_id"] == "h499"


def test_staged_files_are_partitioned_by_day_and_read_back_by_name(spark, base, tmp_path):
    counts = stage(base.raw_transactions(), "transactions", str(tmp_path))
    assert counts == {"raw": 3072, "staged": 1500}
    days = {p.name for p in (tmp_path / "transactions").iterdir() if p.is_dir()}
    assert len(days) == 14 and all(d.startswith("event_date=2024-01-") for d in days)
    staged = read_staged(spark, str(tmp_path), "transactions")
    assert staged.count() == 1500
    # a file from before a column existed reads as nulls
    old = staged.drop("processed_at", "event_date").limit(1)
    old.write.parquet(f"{tmp_path}/transactions/event_date=2023-12-31")
    again = read_staged(spark, str(tmp_path), "transactions")
    row = again.where(F.col("event_date") == "2023-12-31").first()
    assert row["processed_at"] is None and row["transaction_ref"] is not None


def test_empty_input_is_refused(spark, tmp_path):
    with pytest.raises(RuntimeError, match="staged transactions is empty"):
        stage(frame(spark, []), "transactions", str(tmp_path))


def test_metrics(base):
    row = st.transaction_metrics(base.raw_transactions()).first()
    assert row.asDict() == {
        "raw_events": 3072,
        "after_dedupe": 3012,
        "duplicates_removed": 60,
        "transactions_out": 1500,
        "events_collapsed": 1512,
    }


def test_lost_and_doubled_fixture_is_not_vacuous(base):
    raw = base.raw_transactions()
    off = fixtures.lost_and_doubled(raw)
    counts = Counter(r[0] for r in off.select("event_id").collect())
    counts.subtract(Counter(r[0] for r in raw.select("event_id").collect()))
    assert any(n > 0 for n in counts.values()) and any(n < 0 for n in counts.values())
