"""Case sync, lifecycle and the action log, against a sequential model in Python."""

import hashlib
import random
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tallymark.operators import cases as cs
from tallymark.operators import checks as ck
from tallymark.operators.actions import STATES, apply_actions, next_statuses, states_before
from tallymark.schemas import (
    ACTION_REQUEST,
    ACTIONS,
    BREAK,
    CASE,
    CASE_ACTION,
    NOTE_REQUIRED,
    nullable,
)
from tallymark.sources.case_store import CaseStore
from tallymark.sources.queue import Queue

RUN = datetime(2024, 1, 16, tzinfo=UTC)


def cid(n):
    return hashlib.sha256(f"case:v1:TX_{n}".encode()).hexdigest()


def broken(n, **facts):
    """A row of the break feed: charge n, partly paid, with other facts where they are given."""
    row = dict.fromkeys(BREAK.names) | {
        "case_id": cid(n),
        "transaction_ref": f"TX_{n}",
        "merchant_id": f"shop-{n}",
        "channel": "ussd",
        "gateway": "north",
        "currency": "NGN",
        "succeeded_date": date(2024, 1, 9),
        "amount_ngn_kobo": 91_000,
        "expected_net_kobo": 90_100,
        "settled_net_kobo": 52_600,
        "break_type": "partial_settlement",
        "exposure_kobo": 37_500,
    }
    return tuple((row | facts)[name] for name in BREAK.names)


def breaks(spark, *rows):
    return spark.createDataFrame(list(rows), nullable(BREAK))


def stamp(n=0):
    return F.lit(f"2024-01-{16 + n} 00:00:00").cast("timestamp")


def request(i, n, action, key=None, notes="checked", analyst="ada", case=None):
    return (i, case or cid(n), analyst, action, notes, key or f"key-{i:08d}", RUN)


def log(spark, *rows):
    return spark.createDataFrame(list(rows), nullable(ACTION_REQUEST))


@pytest.fixture
def store(spark, tmp_path):
    return CaseStore(spark, str(tmp_path / "store"))


def status_of(store, n):
    row = store.effective().where(F.col("case_id") == cid(n)).first()
    return row["effective_status"], row["drifted"]


# --- Transitions -----------------------------------------------------------------------

#: What an action makes of each status.
LEGAL = {
    "UNTOUCHED": {
        "START_REVIEW": "MANUAL_REVIEW", "ESCALATE": "ESCALATED",
        "MARK_EXPECTED_DELAY": "EXPECTED_DELAY", "CLOSE": "CLOSED",
    },
    "MANUAL_REVIEW": {
        "ESCALATE": "ESCALATED", "MARK_EXPECTED_DELAY": "EXPECTED_DELAY", "CLOSE": "CLOSED",
    },
    "ESCALATED": {"CLOSE": "CLOSED"},
    "EXPECTED_DELAY": {
        "START_REVIEW": "MANUAL_REVIEW", "ESCALATE": "ESCALATED", "CLOSE": "CLOSED",
    },
    "CLOSED": {"REOPEN": "UNTOUCHED"},
}


def test_every_state_and_action_pair(spark):
    pairs = [(s, a) for s in STATES for a in ACTIONS]
    got = next_statuses(spark.createDataFrame(pairs, "status string, action string"), "status", "action")
    for row in got.collect():
        want = LEGAL[row["status"]].get(row["action"])
        assert row["next_status"] == want and row["is_legal"] == (want is not None)


# --- Actions ---------------------------------------------------------------------------


def outcomes(applied):
    return {r["action_id"]: r["outcome"] for r in applied.outcomes.collect()}


def test_reopen_returns_to_the_system_status(store, spark):
    store.sync(breaks(spark, broken(1)), stamp(0))
    store.apply(log(spark, request(1, 1, "CLOSE"), request(2, 1, "REOPEN")))
    assert status_of(store, 1) == ("OPEN", False)
    row = store.cases().first()
    assert row["analyst_status"] is None and row["decided_fingerprint"] is None
    assert store.actions().count() == 2


def test_turned_down_requests_write_nothing(store, spark):
    store.sync(breaks(spark, broken(1)), stamp(0))
    applied = store.apply(
        log(
            spark,
            request(1, 1, "REOPEN"),
            request(2, 1, "CLOSE", notes=" \t\n"),
            request(3, 9, "CLOSE"),
            request(4, 1, "CLOSE", case="nope"),
            request(5, 1, "CLOSE", key="short"),
            request(6, 1, "CLOSE", analyst=" "),
            request(7, 1, "DANCE"),
        )
    )
    assert outcomes(applied) == {
        1: "invalid_transition",
        2: "missing_note",
        3: "case_not_found",
        4: "case_not_found",
        5: "invalid_key",
        6: "analyst_required",
        7: "invalid_action",
    }
    assert store.actions().count() == 0
    assert status_of(store, 1) == ("OPEN", False)


def test_keys_replay_conflict_and_are_kept_across_runs(store, spark):
    store.sync(breaks(spark, broken(1), broken(2)), stamp(0))
    first = store.apply(
        log(
            spark,
            request(1, 1, "ESCALATE", key="key-shared"),
            request(2, 1, "ESCALATE", key="key-shared"),
            request(3, 2, "ESCALATE", key="key-shared"),
            request(4, 1, "CLOSE", key="key-shared"),
            request(5, 2, "REOPEN", key="key-free-again"),
            request(6, 2, "CLOSE", key="key-free-again"),
        )
    )
    assert outcomes(first) == {
        1: "accepted",
        2: "replayed",
        3: "conflict",
        4: "conflict",
        5: "invalid_transition",
        6: "accepted",
    }
    later = store.apply(
        log(
            spark,
            request(11, 1, "ESCALATE", key="key-shared"),
            request(12, 2, "ESCALATE", key="key-shared"),
            request(13, 1, "CLOSE", key="key-new-one"),
        )
    )
    assert outcomes(later) == {11: "replayed", 12: "conflict", 13: "accepted"}
    replay = later.outcomes.where("action_id = 11").first()
    assert replay["replay_of"] == 1
    assert sorted(r["action_id"] for r in store.actions().collect()) == [1, 6, 13]
    assert status_of(store, 1) == ("CLOSED", False)
    assert store.actions().columns == CASE_ACTION.names


def test_audit_log_is_append_only(store, spark):
    store.sync(breaks(spark, broken(1)), stamp(0))
    store.apply(log(spark, request(1, 1, "CLOSE"), request(2, 1, "REOPEN")))
    old = store.actions()
    with pytest.raises(ValueError, match="append-only"):
        store.replace_log(old.where("action_id = 1"))
    with pytest.raises(ValueError, match="append-only"):
        store.replace_log(old.withColumn("notes", F.lit("edited")))
    store.replace_log(old)  # compaction
    assert store.actions().count() == 2
    store.apply(log(spark, request(3, 1, "CLOSE")))
    assert store.actions().count() == 3


def test_an_action_writes_the_cases_it_names(store, spark, tmp_path, monkeypatch):
    from tallymark.sources import case_store as module

    monkeypatch.setattr(module, "FOLD_CHANGES", 3)
    store.sync(breaks(spark, *[broken(n) for n in range(40)]), stamp(0))

    def written():
        state = store.states.live()[1]
        return state["cases"], [spark.read.parquet(f"{store.root}/{name}").count() for name in state["changes"]]

    base, _ = written()
    store.apply(log(spark, request(1, 7, "ESCALATE")))
    store.apply(log(spark, request(2, 7, "CLOSE"), request(3, 8, "START_REVIEW"), request(4, 9, "REOPEN")))
    assert written() == (base, [1, 2])  # the refused request wrote nothing
    assert [status_of(store, n)[0] for n in (6, 7, 8, 9)] == ["OPEN", "CLOSED", "MANUAL_REVIEW", "OPEN"]
    assert store.cases().count() == 40 and agree(store)
    store.apply(log(spark, request(5, 7, "REOPEN")))  # the third change makes a new base
    folded, changes = written()
    assert folded != base and changes == [] and store.cases().count() == 40
    assert [status_of(store, n)[0] for n in (7, 8)] == ["OPEN", "MANUAL_REVIEW"]
    store.sync(breaks(spark, broken(8, exposure_kobo=1)), stamp(1))
    assert status_of(store, 8)[0] == "MANUAL_REVIEW" and status_of(store, 7)[0] == "CLEARED"


def test_the_log_is_a_chain_of_fingerprints(store, spark, tmp_path, monkeypatch):
    store.sync(breaks(spark, broken(1), broken(2)), stamp(0))
    steps = [request(1, 1, "START_REVIEW"), request(2, 2, "CLOSE"), request(3, 1, "CLOSE")]
    for step in steps:
        store.apply(log(spark, step))
    head = store.verify_chain()
    for number in range(3):
        store.verify_segment(number)

    # a compaction is proved by sums, without comparing a row
    monkeypatch.setattr(ck, "removed_audit_rows", lambda *_: pytest.fail("rows were compared"))
    before = store.actions().collect()
    with pytest.raises(ValueError, match="append-only"):
        store.replace_log(store.actions().withColumn("analyst", F.lit("eve")))
    store.replace_log(lambda old: old.coalesce(1))
    monkeypatch.undo()
    assert store.states.live()[1]["links"][0]["before"] == head != store.verify_chain()
    assert sorted(store.actions().collect()) == sorted(before)
    store.apply(log(spark, request(4, 2, "REOPEN")))

    # a changed old row is seen in its segment, the other one is not read
    _, state = store.states.live()
    old, new = state["segments"]
    edited = store._read([old], CASE_ACTION).withColumn("notes", F.lit("edited"))
    edited.write.parquet(str(tmp_path / "edited"))
    (tmp_path / "store" / old).rename(tmp_path / "old")
    (tmp_path / "edited").rename(tmp_path / "store" / old)
    (tmp_path / "store" / new).rename(tmp_path / "away")
    with pytest.raises(ValueError, match="segment 0 is not what was appended"):
        store.verify_segment(0)


def sequential(cases, requests):
    """The rules, one request at a time."""
    state = {c: "UNTOUCHED" for c in cases}
    used, out = {}, {}
    for i, case, analyst, action, notes, key, _ in sorted(requests):
        if not analyst.strip():
            out[i] = ("analyst_required", None, None)
        elif case not in state:
            out[i] = ("case_not_found", None, None)
        elif key in used:
            same = used[key][1:] == (case, action)
            out[i] = ("replayed" if same else "conflict", None, used[key][0] if same else None)
        elif action in NOTE_REQUIRED and not notes.strip():
            out[i] = ("missing_note", None, None)
        elif action not in LEGAL[state[case]]:
            out[i] = ("invalid_transition", None, None)
        else:
            state[case] = LEGAL[state[case]][action]
            used[key] = (i, case, action)
            result = None if state[case] == "UNTOUCHED" else state[case]
            out[i] = ("accepted", result, None)
    return state, out


@pytest.mark.parametrize(("seed", "fan", "gap"), [(1, 4, 1), (2, 16, 7), (3, 1024, 1), (4, 3, 1)])
def test_random_logs_match_the_sequential_rules(spark, seed, fan, gap):
    rng = random.Random(seed)
    n_cases, n_requests, n_keys = 5, 150, 60
    ids = rng.sample(range(1, n_requests * gap * 2), n_requests)
    requests = [
        request(
            i * gap,
            # one case owns half of the log
            0 if rng.random() < 0.5 else rng.randrange(n_cases + 1),
            rng.choice(ACTIONS),
            key=f"key-{rng.randrange(n_keys):06d}",
            notes=rng.choice(["why", "why", " "]),
            analyst=rng.choice(["ada", "ada", "ada", " "]),
        )
        for i in ids
    ]
    snapshot = cs.sync_cases(
        spark.createDataFrame([], nullable(CASE)),
        breaks(spark, *[broken(n) for n in range(n_cases)]),
        stamp(0),
    )
    state, want = sequential([cid(n) for n in range(n_cases)], requests)
    applied = apply_actions(snapshot, log(spark, *requests), fan=fan)
    got = {
        r["action_id"]: (r["outcome"], r["resulting_status"], r["replay_of"])
        for r in applied.outcomes.collect()
    }
    assert got == want
    final = {r["case_id"]: r["analyst_status"] or "UNTOUCHED" for r in applied.cases.collect()}
    assert final == state
    assert {"accepted", "replayed", "conflict", "invalid_transition"} <= {w[0] for w in want.values()}


def test_no_group_holds_more_than_the_fan(spark):
    """A case that owns the whole log is split by action id."""
    n = 3000
    moves = spark.range(1, n + 1).select(
        F.lit(cid(1)).alias("case_id"),
        F.col("id").alias("action_id"),
        F.lit(0).alias("start"),
        F.array(*[F.lit((s + 1) % 5) for s in range(5)]).alias("move"),
        F.struct(F.col("id").alias("tag")).alias("payload"),
    )
    rows = states_before(moves, fan=8).collect()
    assert len(rows) == n
    assert all(r["state"] == (r["action_id"] - 1) % 5 and r["payload"]["tag"] == r["action_id"] for r in rows)


# --- Changes that cross ----------------------------------------------------------------


def crossing(monkeypatch, store, other):
    """Another writer changes the store just before the first commit that follows."""
    from tallymark.sources import files as module

    real, left = module.create_file, [other]

    def create(spark, path, text):
        if left:
            left.pop()()
        return real(spark, path, text)

    monkeypatch.setattr(module, "create_file", create)


def agree(store):
    """Every decided case has an action in the log that says so."""
    last = store.actions().groupBy("case_id").agg(F.max_by("resulting_status", "action_id").alias("last"))
    both = store.cases().join(last, "case_id", "left")
    return both.where(~F.col("analyst_status").eqNullSafe(F.col("last"))).isEmpty()


def test_an_action_inside_a_sync_is_not_lost(store, spark, monkeypatch):
    store.sync(breaks(spark, broken(1), broken(2)), stamp(0))
    crossing(monkeypatch, store, lambda: store.apply(log(spark, request(1, 1, "CLOSE"))))
    store.sync(breaks(spark, broken(1, exposure_kobo=77), broken(2)), stamp(1))
    assert status_of(store, 1) == ("CLOSED", True)
    assert store.actions().count() == 1 and agree(store)


def test_two_crossing_applies_keep_both(store, spark, monkeypatch):
    store.sync(breaks(spark, broken(1), broken(2)), stamp(0))
    crossing(monkeypatch, store, lambda: store.apply(log(spark, request(1, 1, "CLOSE"))))
    applied = store.apply(log(spark, request(2, 1, "START_REVIEW"), request(3, 2, "ESCALATE")))
    assert outcomes(applied)[3] == "accepted" and outcomes(applied)[2] != "accepted"
    assert sorted(r.action_id for r in store.actions().collect()) == [1, 3]
    assert status_of(store, 1)[0] == "CLOSED" and status_of(store, 2)[0] == "ESCALATED"
    assert agree(store)


def test_a_log_rewrite_crossing_an_apply_loses_no_row(store, spark, monkeypatch):
    store.sync(breaks(spark, broken(1), broken(2)), stamp(0))
    store.apply(log(spark, request(1, 1, "CLOSE")))
    crossing(monkeypatch, store, lambda: store.apply(log(spark, request(2, 2, "ESCALATE"))))
    store.replace_log(lambda old: old.coalesce(1))
    assert sorted(r.action_id for r in store.actions().collect()) == [1, 2] and agree(store)
    stale = spark.createDataFrame(store.actions().where("action_id = 1").collect(), nullable(CASE_ACTION))
    with pytest.raises(ValueError, match="append-only"):
        store.replace_log(stale)


def test_old_states_and_their_files_go(store, spark, tmp_path):
    from tallymark.sources.case_store import KEEP_STATES

    for n in range(KEEP_STATES + 3):
        store.sync(breaks(spark, broken(1, exposure_kobo=n)), stamp(0))
    assert len(list((tmp_path / "store" / "states").glob("*.json"))) == KEEP_STATES
    assert len(list((tmp_path / "store" / "cases").glob("v=*"))) == KEEP_STATES
    assert store.cases().first()["exposure_kobo"] == KEEP_STATES + 2


@pytest.mark.parametrize("column", ["case_id", "break_type", "merchant_id", "exposure_kobo"])
def test_a_break_without_a_required_field_is_refused(store, spark, column):
    store.sync(breaks(spark, broken(1)), stamp(0))
    feed = breaks(spark, broken(1), broken(2)).withColumn(
        column, F.when(F.col("transaction_ref") == broken(1)[1], F.col(column))
    )
    with pytest.raises(ValueError, match="constraint violated|not unique"):
        store.sync(feed, stamp(1))
    assert store.cases().count() == 1


# --- Views and queue -------------------------------------------------------------------


def test_queue_order_filter_pages_and_totals(store, spark):
    facts = [(310, 14), (88_000, 20), (310, 11), (4_050, 12)]
    rows = [
        broken(n, exposure_kobo=kobo, succeeded_date=date(2024, 1, day))
        for n, (kobo, day) in enumerate(facts, 1)
    ]
    rows.append(broken(5, break_type="overpaid", exposure_kobo=6))
    store.sync(breaks(spark, *rows), stamp(0))
    effective = store.effective()
    order = [r["transaction_ref"] for r in cs.queue_page(effective).collect()]
    assert order == ["TX_2", "TX_4", "TX_3", "TX_1", "TX_5"]
    page = cs.queue_page(effective, limit=2, offset=1).collect()
    assert [r["transaction_ref"] for r in page] == ["TX_4", "TX_3"]
    assert cs.queue_total(effective).first()[0] == 5
    assert cs.queue_total(effective, break_type="overpaid").first()[0] == 1
    with pytest.raises(ValueError, match="no view named"):
        cs.queue_page(effective, "mine")


def test_pages_after_a_cursor_are_those_by_offset(base, spark, tmp_path):
    effective, queue = base.effective(), Queue(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        queue.total()
    queue.write(effective, ranges=7)
    for view, kind, limit in (("active", None, 17), ("all", "short_paid", 5), ("closed", None, 3), ("mine", None, 1)):
        if view == "mine":
            with pytest.raises(ValueError, match="no view named"):
                queue.page(view).collect()
            continue
        total = cs.queue_total(effective, view, kind).first()[0]
        assert queue.total(view, kind) == total
        seen, cursor = [], None
        while True:
            page = queue.page(view, kind, limit, cursor).collect()
            if not page:
                break
            seen += [r["case_id"] for r in page]
            cursor = tuple(page[-1][c] for c in cs.QUEUE_ORDER)
        want = [r["case_id"] for r in cs.queue_page(effective, view, kind, limit=total + 1).collect()]
        assert seen == want and len(seen) == total


def test_a_page_and_a_case_read_little(base, spark, tmp_path):
    queue = Queue(spark, str(tmp_path))
    queue.write(base.effective(), ranges=7)
    tenth = queue.page(limit=10).collect()[-1]
    page = queue.page(limit=5, after=tuple(tenth[c] for c in cs.QUEUE_ORDER))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = page._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].splitlines()[0]
    assert "LessThanOrEqual(exposure_kobo" in pushed and "GreaterThanOrEqual(exposure_kobo" in pushed
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    one = queue.case(tenth["case_id"], base.applied().recorded)
    plan = one._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(bucket" in plan
    assert {r["case_id"] for r in one.collect()} == {tenth["case_id"]}
    queue.write(base.effective().limit(3))
    assert queue.total("all") == 3


def test_summary_is_exact_past_double_precision(store, spark):
    big = 2**53 + 1
    store.sync(breaks(spark, broken(1, exposure_kobo=big), broken(2, break_type="overpaid", exposure_kobo=300), broken(3)), stamp(0))
    store.apply(log(spark, request(1, 3, "CLOSE")))
    row = cs.queue_summary(store.effective()).first()
    assert (row["active_cases"], row["active_exposure_kobo"], row["drifted_cases"]) == (2, big + 300, 0)
    by_type = [tuple(r) for r in cs.active_summary(store.effective()).collect()]
    assert by_type == [("partial_settlement", 1, big), ("overpaid", 1, 300)]


def test_case_page_lists_actions_in_order(store, spark):
    store.sync(breaks(spark, broken(1), broken(2)), stamp(0))
    store.apply(log(spark, request(5, 1, "START_REVIEW", notes=""), request(7, 1, "ESCALATE")))
    assert [r["action"] for r in store.case(cid(1)).collect()] == ["START_REVIEW", "ESCALATE"]
    assert [r["action"] for r in store.case(cid(2)).collect()] == [None]
    assert store.case("unknown").count() == 0


def test_constraints_find_each_fault(base):
    from tallymark.plans import fixtures

    broken = ck.case_constraint_violations(fixtures.break_cases(base.second_cases()))
    names = {r["constraint_name"] for r in broken.collect()}
    assert len(names) == 7
    assert ck.case_constraint_violations(base.second_cases()).isEmpty()


# --- Sync ------------------------------------------------------------------------------


def test_a_feed_opens_and_clears_cases(store, spark):
    feed = [broken(n) for n in (4, 5, 6)]
    assert store.sync(breaks(spark, *feed), stamp(0)) == {"open": 3, "cleared": 0}
    assert store.sync(breaks(spark, *feed), stamp(0)) == {"open": 3, "cleared": 0}  # a rerun
    assert store.sync(breaks(spark, *feed[1:]), stamp(1)) == {"open": 2, "cleared": 1}
    assert [status_of(store, n) for n in (4, 5, 6)] == [("CLEARED", False), ("OPEN", False), ("OPEN", False)]
    assert store.sync(breaks(spark, *feed), stamp(2)) == {"open": 3, "cleared": 0}
    assert status_of(store, 4) == ("OPEN", False)
    assert store.cases().columns == CASE.names


def test_a_sync_refreshes_facts_but_not_the_first_seen_ones(store, spark):
    store.sync(breaks(spark, broken(8), broken(9)), stamp(0))
    moved = broken(8, break_type="overpaid", exposure_kobo=61, merchant_id="renamed")
    store.sync(breaks(spark, moved), stamp(1))
    seen, gone = (store.cases().where(F.col("case_id") == cid(n)).first() for n in (8, 9))
    assert (seen["exposure_kobo"], seen["system_fingerprint"]) == (61, "overpaid:61")
    assert seen["merchant_id"] == "shop-8"
    assert seen["display_id"] == f"CASE-{cid(8)[:16].upper()}"
    assert seen["last_seen_at"] > seen["first_seen_at"] == gone["first_seen_at"] == gone["last_seen_at"]


def test_a_decision_outlives_its_break(store, spark):
    store.sync(breaks(spark, broken(3)), stamp(0))
    store.apply(log(spark, request(1, 3, "CLOSE")))
    for day, feed in enumerate(([], [broken(3)], [broken(3)]), 1):
        store.sync(spark.createDataFrame(feed, nullable(BREAK)), stamp(day))
        assert status_of(store, 3) == ("CLOSED", False)
    assert store.actions().count() == 1


def test_only_decisions_about_facts_drift(store, spark):
    store.sync(breaks(spark, broken(2), broken(7)), stamp(0))
    store.apply(log(spark, request(1, 2, "ESCALATE"), request(2, 7, "CLOSE")))
    store.sync(breaks(spark, *[broken(n, exposure_kobo=38_000 + n) for n in (2, 7)]), stamp(1))
    assert status_of(store, 2) == ("ESCALATED", False)  # says nothing about the facts
    assert status_of(store, 7) == ("CLOSED", True)
    pages = {view: cs.queue_page(store.effective(), view).count() for view in ("active", "closed")}
    assert pages == {"active": 2, "closed": 0}


def test_failed_sync_leaves_the_old_state(store, spark):
    store.sync(breaks(spark, broken(1)), stamp(0))
    with pytest.raises(ValueError, match="exposure_not_negative"):
        store.sync(breaks(spark, broken(1, exposure_kobo=-5), broken(2)), stamp(1))
    with pytest.raises(ValueError, match="occurs twice"):
        store.sync(breaks(spark, broken(1), broken(1)), stamp(1))
    assert [r["exposure_kobo"] for r in store.cases().collect()] == [37_500]


def test_empty_mart_clears_nothing(store, spark, base):
    store.sync_mart(base.recon, stamp(0))
    with pytest.raises(RuntimeError, match="refusing to clear"):
        store.sync_mart(base.recon.where("false"), stamp(1))
    # a mart without breaks is a good day, not a failed load
    done = store.sync_mart(base.recon.where("not is_break"), stamp(1))
    assert done == {"open": 0, "cleared": 115}


