"""The mart against row-at-a-time Python, and every case of its ordered rules."""

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tallymark.operators import checks as ck
from tallymark.operators import marts
from tallymark.operators import reconcile as rc
from tallymark.operators import reports as rp
from tallymark.plans import fixtures

TX = (
    "transaction_ref string, merchant_id string, customer_id string, channel string,"
    " gateway string, bank_code string, currency string, status string, amount_ngn_kobo bigint,"
    " fee_ngn_kobo bigint, successful_at timestamp, ingested_at timestamp,"
    " expected_settlement_date date, settlement_source_watermark_at timestamp, is_success boolean,"
    " is_reversed boolean, is_settlement_eligible boolean, arrival_lag_seconds bigint,"
    " event_date date, created_at timestamp"
)
STL = (
    "settlement_id string, payout_id string, transaction_ref string, merchant_id string,"
    " gross_kobo bigint, fee_kobo bigint, net_kobo bigint, currency string, settlement_date date,"
    " settled_at timestamp, ingested_at timestamp"
)


def day(n, hour=0):
    return datetime(2024, 1, n, hour, tzinfo=UTC)


def tx(ref, status="success", due=2, source=20, succeeded=1, net=1000, asof=15):
    return (
        ref, "m", "c", "card", "g", None, "NGN", status, net + 10, 10,
        day(succeeded) if status in ("success", "reversed") else None, day(asof),
        date(2024, 1, due), day(source, 5) if source else None, status == "success",
        status == "reversed", status == "success", 5, date(2024, 1, 1), day(1),
    )


def stl(ref, net, sid=None):
    return (sid or f"s-{ref}", "p", ref, "m", net + 10, 10, net, "NGN", date(2024, 1, 2), day(2), day(2))


def mart(spark, charges, lines):
    rows = rc.reconcile(spark.createDataFrame(charges, TX), spark.createDataFrame(lines, STL))
    return {(r["transaction_ref"], r["settlement_id"]): r for r in rows.collect()}


def test_every_status_bucket_and_amount(spark):
    charges = [
        tx("matched"),
        tx("partial"),
        tx("edge"),
        tx("short"),
        tx("over"),
        tx("back", "reversed"),
        tx("back_unpaid", "reversed"),
        tx("failed", "failed"),
        tx("missing"),
        tx("stale", due=21),
        tx("unknown_source", source=None),
        tx("t1", succeeded=14),
        tx("t2", succeeded=13),
        tx("within", due=16, succeeded=10),
    ]
    lines = [
        stl("matched", 1000),
        stl("partial", 899),
        stl("edge", 900),
        stl("short", 999),
        stl("over", 1001),
        stl("back", 1000),
        stl("orphan", 5),
    ]
    got = mart(spark, charges, lines)
    verdict = {
        ref: (
            r["reconciliation_status"], r["reconciliation_bucket"], r["outstanding_net_kobo"],
            r["is_break"], r["exposure_kobo"],
        )
        for (ref, _), r in got.items()
    }
    assert verdict == {
        "matched": ("matched", "settled", 0, False, 0),
        "partial": ("partial_settlement", "settled", 101, True, 101),
        "edge": ("short_paid", "settled", 100, True, 100),
        "short": ("short_paid", "settled", 1, True, 1),
        "over": ("overpaid", "settled", 0, True, 1),
        "back": ("reversed_after_settlement", "settled", 0, True, 1000),
        "missing": ("missing_settlement", "breached_sla", 1000, True, 1000),
        "stale": ("unverified_source", "pending_within_sla", 1000, False, 0),
        "unknown_source": ("missing_settlement", "breached_sla", 1000, True, 1000),
        "t1": ("missing_settlement", "pending_t1", 1000, False, 0),
        "t2": ("missing_settlement", "pending_t2", 1000, False, 0),
        "within": ("missing_settlement", "pending_within_sla", 1000, False, 0),
    }
    fresh = {ref: r["source_freshness_status"] for (ref, _), r in got.items()}
    assert fresh["stale"] == fresh["unknown_source"] == "stale_or_incomplete"
    assert fresh["missing"] == "fresh"
    for (_, sid), row in got.items():
        assert row["is_settled"] == (sid is not None)
        assert (row["settlement_variance_kobo"] is None) == (sid is None)
        assert row["break_type"] == (row["reconciliation_status"] if row["is_break"] else None)
        assert len(row["case_id"]) == 64


def test_two_lines_for_one_charge_stay_two_rows(spark):
    got = mart(spark, [tx("a")], [stl("a", 1000, "s1"), stl("a", 1000, "s2")])
    assert set(got) == {("a", "s1"), ("a", "s2")}


def test_amounts_past_double_precision_stay_exact(spark):
    big = 2**53 + 1
    got = mart(spark, [tx("a", net=big)], [stl("a", big - 1)])
    row = got[("a", "s-a")]
    assert row["settlement_variance_kobo"] == -1 and row["reconciliation_status"] == "short_paid"


def test_a_charge_with_a_third_of_all_lines(spark):
    """The hot ref is on the inner-join side, so skew handling can split it."""
    charges = [tx(f"t{i}") for i in range(40)]
    lines = [stl("t0", 1000, f"hot{i}") for i in range(400)] + [stl(f"t{i}", 1000) for i in range(30)]
    a, b = spark.createDataFrame(charges, TX), spark.createDataFrame(lines, STL)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = rc.reconcile(a, b.repartition(8))
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 430 + 10
    assert "skew=true" in plan


def test_no_cross_join_and_no_python_in_the_plan(base):
    out = rc.reconcile(base.stg_transactions(), base.stg_settlements())
    plan = out._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ObjectHash"):
        assert word not in plan, word


def test_staged_scan_reads_only_needed_columns_and_pushes_the_status_filter(base):
    plan = rc.reconcile(
        base.stg_transactions(), base.stg_settlements()
    )._jdf.queryExecution().executedPlan().toString()
    assert "customer_id" not in plan and "PushedFilters: [" in plan
    assert "EqualTo(status,success)" in plan


def test_published_mart_counts(base):
    got = {
        r[0]: r[1] for r in base.recon.groupBy("reconciliation_status").count().collect()
    }
    assert got == {
        "matched": 1253,
        "missing_settlement": 61,
        "partial_settlement": 14,
        "short_paid": 13,
        "overpaid": 17,
        "reversed_after_settlement": 16,
        "unverified_source": 2,
    }
    buckets = {r[0]: r[1] for r in base.recon.groupBy("reconciliation_bucket").count().collect()}
    assert buckets == {
        "settled": 1313,
        "pending_t1": 1,
        "pending_t2": 5,
        "pending_within_sla": 2,
        "breached_sla": 55,
    }
    assert base.recon.where("is_break").count() == 115


def test_sums_stay_integer(base):
    types = dict(base.daily.dtypes)
    assert types["gross_successful_kobo"] == types["net_successful_kobo"] == "bigint"
    assert types["success_rate"] == "double"


def test_merchant_day_without_success_has_null_sums(spark):
    row = marts.mart_merchant_daily(spark.createDataFrame([tx("a", "failed")], TX)).first()
    assert row["attempts"] == 1 and row["success_rate"] == 0.0
    assert row["gross_successful_kobo"] is None and row["gross_attempted_kobo"] == 1010


def test_checks_pass_on_sound_marts_and_fail_on_broken_ones(base, faulty):
    hard, soft = ck.enforce(ck.serving_report(base.tables()))
    assert hard == [] and len(soft) >= 1
    with pytest.raises(RuntimeError, match="reconciliation_ties_to_fact"):
        ck.enforce(ck.serving_report(faulty.tables()))
    empty = {**base.tables(), "mart_merchant_daily": base.daily.where("false")}
    with pytest.raises(RuntimeError, match="mart_merchant_daily_non_empty"):
        ck.enforce(ck.serving_report(empty))
    for check in (
        ck.break_flags_inconsistent,
        ck.matched_with_outstanding,
        ck.inconsistent_matched,
        ck.stale_but_missing,
    ):
        assert check(base.recon).isEmpty(), check.__name__
        assert not check(fixtures.break_recon(base.recon)).isEmpty(), check.__name__
    assert ck.negative_money(base.fct_tx).isEmpty()
    assert ck.usd_without_rate(base.fct_tx).isEmpty()
    assert ck.settled_before_charge(base.fct_stl).isEmpty()
    assert ck.success_rate_out_of_range(base.daily, base.channels).isEmpty()
    for rules in (ck.not_null_rules, ck.accepted_rules, ck.unique_rules):
        tables = {
            "stg_transactions": base.stg_transactions(),
            "stg_settlements": base.stg_settlements(),
            **base.tables(),
        }
        assert rules(tables).where(F.col("violations") > 0).isEmpty(), rules.__name__


def test_bags_count_copies(spark):
    a = spark.createDataFrame([(x,) for x in "aabbc"], "event_id string")
    b = spark.createDataFrame([(x,) for x in "abbbd"], "event_id string")
    row = ck.compare_bags(a, b, "event_id").first()
    assert row.asDict() == {"expected": 5, "found": 4, "extra": 1, "missing": 2, "exact": False}
    assert ck.compare_bags(a, a, "event_id").first()["exact"]
    sides = sorted((r["event_id"], r["side"]) for r in ck.bag_difference(a, b, "event_id").collect())
    assert sides == [("a", "missing"), ("b", "extra"), ("c", "missing"), ("d", "extra")]


def test_shares_add_up(base):
    total = rp.reconciliation_breakdown(base.recon).agg(F.sum("pct")).first()[0]
    assert abs(total - 100) < 0.05
