"""Joins over tables that lie together by reference, and bags compared by ranges."""

import pytest
from pyspark.sql import functions as F

from tallymark.operators import checks as ck
from tallymark.operators import fingerprints as fp
from tallymark.operators import marts
from tallymark.operators import reconcile as rc
from tallymark.sources import by_reference as br
from tests.test_reconcile import STL, TX, stl, tx


def same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    conf = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in conf:
        spark.conf.set(key, "-1")
    yield
    for key in conf:
        spark.conf.unset(key)


def test_marts_equal_those_of_plain_tables(base, faulty):
    for ws in (base, faulty):
        layout, charges, lines = ws.by_reference(), ws.stg_transactions(), ws.stg_settlements()
        same(rc.reconcile_by_reference(layout), rc.reconcile(charges, lines))
        same(marts.fct_settlements_by_reference(layout), marts.fct_settlements(lines, charges))
        same(ck.expected_mart_rows_by_reference(layout), ck.expected_mart_rows(ws.fct_tx, ws.fct_stl))
        same(layout.one_each().select(charges.columns), charges)


def test_joins_move_no_staged_row(base, no_broadcast):
    layout = base.by_reference()
    for df in (rc.reconcile_by_reference(layout), marts.fct_settlements_by_reference(layout)):
        plan = plan_of(df)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    counted = plan_of(ck.expected_mart_rows_by_reference(layout))
    assert counted.count("Exchange") <= 2 and "hashpartitioning" not in counted  # of one count


def test_a_reference_with_a_third_of_all_lines_lies_in_many_buckets(spark, tmp_path, no_broadcast):
    charges = [tx(f"t{i}") for i in range(40)] + [tx("back", "reversed"), tx("never", "reversed")]
    lines = [stl("t0", 1000, f"hot{i}") for i in range(300)] + [stl("back", 900, f"b{i}") for i in range(200)]
    lines += [stl(f"t{i}", 1000) for i in range(30)] + [stl(None, 5, f"n{i}") for i in range(200)]
    lines += [stl("stranger", 7)]
    a, b = spark.createDataFrame(charges, TX), spark.createDataFrame(lines, STL)
    layout = br.write_by_reference(a, b, str(tmp_path / "layout"), buckets=4, hot_lines=50)
    slots = {r[0]: r[1] for r in layout.charges.groupBy("transaction_ref").count().collect()}
    assert slots["t0"] == 7 and slots["back"] == 4 and slots["t1"] == 1
    spread = layout.lines.groupBy("transaction_ref", "ref_slot").count()
    assert spread.agg(F.max("count")).first()[0] < 120
    assert layout.one_each().count() == len(charges)
    same(rc.reconcile_by_reference(layout), rc.reconcile(a, b))
    same(marts.fct_settlements_by_reference(layout), marts.fct_settlements(b, a))
    assert "Exchange" not in plan_of(rc.reconcile_by_reference(layout))
    same(ck.expected_mart_rows_by_reference(layout), ck.expected_mart_rows(a, b))


def test_a_layout_is_opened_again_and_half_a_layout_is_not(spark, base, tmp_path, no_broadcast):
    path = str(tmp_path / "layout")
    with pytest.raises(FileNotFoundError):
        br.open_by_reference(spark, path)
    first = br.write_by_reference(base.stg_transactions(), base.stg_settlements(), path)
    br.drop_by_reference(spark, path)  # as a session that has never seen it
    again = br.open_by_reference(spark, path)
    assert (again.as_of, again.buckets) == (first.as_of, first.buckets)
    out = rc.reconcile_by_reference(again)
    assert "Exchange" not in plan_of(out)
    same(out, rc.reconcile(base.stg_transactions(), base.stg_settlements()))


def test_empty_tables_lie_together_too(spark, tmp_path):
    a, b = spark.createDataFrame([], TX), spark.createDataFrame([], STL)
    layout = br.write_by_reference(a, b, str(tmp_path / "layout"), buckets=2)
    assert layout.as_of is None and rc.reconcile_by_reference(layout).count() == 0
    assert marts.fct_settlements_by_reference(layout).count() == 0


def test_the_gate_exchanges_references_once(base):
    tables = {"stg_transactions": base.stg_transactions(), "stg_settlements": base.stg_settlements(), **base.tables()}
    plan = plan_of(ck.data_tests(tables))
    assert plan.count("hashpartitioning") == 2 and "Join" not in plan


# --- bags


KEYS = "k string, other long"


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_differences_by_ranges_are_all_differences(spark, levels, monkeypatch):
    keys = [f"key-{i}" for i in range(3000)]
    left = spark.createDataFrame([(k, 1) for k in [*keys, None, "twice", "twice"]], KEYS)
    right = spark.createDataFrame([(k, 2) for k in [*keys[5:], keys[9], keys[9], None, None, "twice"]], KEYS)
    want = {("key-0", "missing", 1), ("key-9", "extra", 2), ("twice", "missing", 1), (None, "extra", 1)}
    want |= {(f"key-{i}", "missing", 1) for i in range(1, 5)}
    assert set(map(tuple, fp.bag_difference_by_ranges(left, right, "k", levels).collect())) == want
    monkeypatch.setattr(fp, "NAMED", 2)
    assert set(map(tuple, fp.bag_difference_by_ranges(left, right, "k", levels).collect())) == want


def test_equal_bags_exchange_ranges_only(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    turned = keys.orderBy(F.desc("k"))
    assert fp.differing_ranges(keys, turned, "k").isEmpty()
    plan = plan_of(fp.range_fingerprints(keys, keys, "k", 2))
    assert plan.count("hashpartitioning") == 1 and "hashpartitioning(key" not in plan
    assert fp.bag_difference_by_ranges(keys, turned, "k").isEmpty()
    swapped = keys.where("k <> '17'").unionByName(spark.createDataFrame([("18",)], "k string"))
    ranges = fp.differing_ranges(keys, swapped, "k").collect()
    assert len(ranges) == 2 and all(r.expected != r.found for r in ranges)
    assert fp.differing_ranges(keys.limit(0), keys.limit(0), "k").isEmpty()
