"""Events are made where they are grouped: only the given columns move."""

import pytest
from pyspark.sql import functions as F

from tallymark.operators import checks, marts, staging
from tallymark.operators import reconcile as rc
from tallymark.operators.actions import states_before
from tallymark.plans import fixtures


@pytest.fixture(scope="module")
def no_broadcast(spark):
    conf = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in conf:
        spark.conf.set(key, "-1")
    yield
    for key in conf:
        spark.conf.unset(key)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" +-:") for line in plan.splitlines() if "Exchange" in line]


@pytest.mark.parametrize("kind", ["base", "faulty"])
def test_staging_moves_orders_and_lines_once(kind, request, no_broadcast):
    ws = request.getfixturevalue(kind)
    charges = exchanges(staging.stage_transactions(ws.raw_transactions()))
    lines = exchanges(staging.stage_settlements(ws.raw_settlements()))
    assert len(charges) == 1
    assert len(lines) == 2
    assert all("REPARTITION_BY_NUM" in line for line in charges + lines)


def test_tasks_follow_rows(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "ORDERS_A_TASK", 10)
    monkeypatch.setattr(fixtures, "LINES_A_TASK", 10)
    cores = spark.sparkContext.defaultParallelism
    assert fixtures.tasks_for(spark.range(3)) == cores
    assert fixtures.tasks_for(spark.range(1001)) == 101
    assert fixtures.tasks_for(spark.range(1001), spark.range(5000)) == 500


def test_orders_without_key_or_lines(spark):
    """A null key is a charge without reference, as before; its lines match nothing."""
    orders = spark.createDataFrame(
        [(1, 10, 5.0), (None, 11, 6.0), (3, 12, 7.0)],
        "o_orderkey bigint, o_custkey bigint, o_totalprice double",
    )
    lineitem = spark.createDataFrame([(1,), (1,), (None,), (9,)], "l_orderkey bigint")
    events = fixtures.transaction_events(fixtures.charges_by_ref(orders, 3))
    plain = fixtures.transaction_events(fixtures.charges(orders))
    assert events.exceptAll(plain).isEmpty() and plain.exceptAll(events).isEmpty()
    assert events.where(F.col("transaction_ref").isNull()).count() > 0
    lines = fixtures.settlement_events(orders, lineitem, 3)
    assert [r[0] for r in lines.select("transaction_ref").collect()] == ["TX_0000000001"] * 2


def test_events_are_made_in_one_step(base):
    plan = base.raw_transactions()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1


def test_queue_ranges_follow_cases(spark, base, monkeypatch):
    from tallymark.plans import workspace

    cases = base.effective()
    size = max(1, cases.count() // 9)
    monkeypatch.setattr(workspace, "RANGE_CASES", size)
    ws = workspace.Workspace(spark, base.sf_dir, False)
    monkeypatch.setattr(ws, "effective", lambda: cases)
    assert len(ws.queue()._live()["ranges"]) >= 9


@pytest.mark.parametrize("kind", ["base", "faulty"])
def test_staged_tables_stay_where_events_were_made(kind, request, no_broadcast):
    ws = request.getfixturevalue(kind)
    charges, lines = ws.stg_transactions(), ws.stg_settlements()
    for table in (charges, lines, ws.fct_stl):
        assert len(table.inputFiles()) == ws.tasks()
    assert not exchanges(marts.fct_settlements(lines, charges))
    mart = rc.reconcile(charges, lines)
    assert not [line for line in exchanges(mart) if "hashpartitioning" in line]
    # the reversed charges move, the lines don't
    expected = exchanges(checks.expected_mart_rows(charges, lines))
    assert not [line for line in expected if "hashpartitioning" in line]


def test_cases_with_few_actions_move_once(spark):
    moves = spark.range(600).selectExpr(
        "concat('c', id % 200) as case_id",
        "id * 1000000 as action_id",
        "0 as start",
        "array(1, 2, 3, 4, 0) as move",
        "named_struct('tag', id) as payload",
    )
    states = states_before(moves)
    assert len(exchanges(states)) == 1
    assert {(r["payload"]["tag"] // 200, r["state"]) for r in states.collect()} == {(0, 0), (1, 1), (2, 2)}


def test_short_and_long_cases_in_one_log(spark):
    moves = spark.range(100).selectExpr(
        "if(id < 40, 'long', concat('c', id % 30)) as case_id",
        "id as action_id",
        "0 as start",
        "array(1, 2, 3, 4, 0) as move",
        "named_struct('tag', id) as payload",
    )
    got = {(r["case_id"], r["action_id"]): r["state"] for r in states_before(moves, fan=8).collect()}
    seen, want = {}, {}
    for row in sorted(moves.collect(), key=lambda r: r["action_id"]):
        at = seen.get(row["case_id"], 0)
        want[row["case_id"], row["action_id"]] = at % 5
        seen[row["case_id"]] = at + 1
    assert got == want
