import json
from functools import reduce
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallymark import functions as fn
from tallymark.operators import checks
from tallymark.operators import ledger as lg
from tallymark.operators import staging as st
from tallymark.plans import fixtures
from tallymark.plans.nightly import run, staged_root
from tallymark.schemas import (
    PUBLISH_LEDGER,
    STATUS_RANK,
    STATUSES,
    TRANSACTION_EVENT,
    TRANSITIONS,
    nullable,
)
from tallymark.session import work_root
from tallymark.sources import files
from tallymark.sources import publish as publish_module
from tallymark.sources.publish import (
    MARTS,
    drop_old_versions,
    live_versions,
    publish,
    publish_all,
    published,
    served,
)
from tallymark.sources.tables import read_json, read_staged, write_json, write_table
from tallymark.sources.topics import file_messages
from tallymark.streaming import live
from tallymark.streaming.drain import Dataset, drain
from tallymark.streaming.live import (
    deduped,
    keep_first_deliveries,
    live_snapshot,
    merge_latest,
    start_dedupe,
    start_latest_status,
)

# --- Publishing ------------------------------------------------------------------------


def test_publish_swaps_and_refuses_an_empty_table(spark, base, tmp_path):
    root = str(tmp_path)
    first = publish(base.fct_tx, "fct_transactions", root)
    assert first["rows"] == 1500
    live = published(spark, root, "fct_transactions")
    assert live.columns == base.fct_tx.columns and live.dtypes == base.fct_tx.dtypes
    assert spark.table("fct_transactions").count() == 1500
    with pytest.raises(RuntimeError, match="0 rows written"):
        publish(base.fct_tx.where("false"), "fct_transactions", root)
    assert live_versions(spark, root) == {"fct_transactions": first["version"]}

    half = publish(base.fct_tx.where("is_success"), "fct_transactions", root)
    assert live.count() == 1500  # a reader that resolved the old version keeps it
    assert published(spark, root, "fct_transactions").count() == half["rows"] == 1360
    assert spark.table("fct_transactions").count() == 1360
    # versions that kept manifests name stay, what a refused or dead run left goes
    assert drop_old_versions(spark, root, "fct_transactions", keep=1) == 1
    for _ in range(3):
        publish(base.fct_tx, "fct_transactions", root)
    assert len(list((tmp_path / "fct_transactions").glob("v=*"))) == 3
    assert published(spark, root, "fct_transactions").count() == 1500


def test_publish_one_by_name(spark, base, tmp_path):
    done = publish_all(base.tables(), str(tmp_path), only="mart_merchant_daily")
    assert [d["table"] for d in done] == ["mart_merchant_daily"]
    with pytest.raises(ValueError, match="no mart named"):
        publish_all(base.tables(), str(tmp_path), only="mart_of_dreams")
    with pytest.raises(FileNotFoundError):
        published(spark, str(tmp_path), "fct_settlements")


def test_published_files_are_sorted_and_split_by_month(spark, base, tmp_path):
    publish(base.fct_stl, "fct_settlements", str(tmp_path), view=False)
    version = live_versions(spark, str(tmp_path))["fct_settlements"]
    folder = tmp_path / "fct_settlements" / version
    assert [p.name for p in folder.iterdir() if p.is_dir()] == ["month=202401"]
    for part in folder.rglob("*.parquet"):
        rows = spark.read.parquet(str(part)).select("settlement_date", "merchant_id", "settlement_id")
        rows = [tuple(r) for r in rows.collect()]
        assert rows == sorted(rows)
    assert set(MARTS) == set(base.tables())


def test_plain_sinks(spark, base, tmp_path):
    write_table(base.daily, str(tmp_path / "daily"))
    assert spark.read.parquet(str(tmp_path / "daily")).count() == base.daily.count()
    raw = base.raw_transactions()
    write_json(raw, str(tmp_path / "events"))
    back = read_json(spark, str(tmp_path / "events"), TRANSACTION_EVENT)
    assert back.exceptAll(raw).isEmpty() and back.count() == raw.count()


def test_a_crash_at_any_step_shows_one_run(spark, base, tmp_path, monkeypatch):
    """Publishing dies at each of its steps in turn: readers see the old five tables."""
    root, tables = str(tmp_path), base.tables()
    publish_all(tables, root)
    before = live_versions(spark, root)
    assert set(before) == set(MARTS)

    class Crash(Exception):
        pass

    def dies(*_, **__):
        raise Crash

    steps = [(publish_module, "write_draft"), (publish_module, "read_version"), (files, "create_file")]
    for module, name in steps:
        monkeypatch.setattr(module, name, dies)
        with pytest.raises(Crash):
            publish_all(tables, root, gate=lambda drafts: None)
        monkeypatch.undo()
        assert live_versions(spark, root) == before
        assert {n: df.count() for n, df in served(spark, root).items()} == {n: df.count() for n, df in tables.items()}
    publish_all(tables, root)
    assert not set(live_versions(spark, root).values()) & set(before.values())


def test_publishers_that_cross_keep_both_tables(spark, base, tmp_path, monkeypatch):
    root = str(tmp_path)
    crossing(monkeypatch, lambda: publish(base.daily, "mart_merchant_daily", root, view=False))
    publish(base.channels, "mart_channel_performance", root, view=False)
    assert set(live_versions(spark, root)) == {"mart_merchant_daily", "mart_channel_performance"}


# --- Continuous forms ------------------------------------------------------------------


def split_events(base, folder, parts=3):
    """Raw events as several files, so the stream sees several batches."""
    raw = base.raw_transactions().withColumn("part", F.abs(F.xxhash64("event_id")) % parts)
    for part in range(parts):
        raw.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(folder)
    return nullable(TRANSACTION_EVENT)


def test_stream_of_events_ends_in_the_batch_result(spark, base, tmp_path):
    folder = str(tmp_path / "events")
    schema = split_events(base, folder)

    def source():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    start_latest_status(source(), out, checkpoint).awaitTermination()
    live = live_snapshot(spark, out)
    batch = st.latest_status(st.dedupe_transactions(base.raw_transactions()))
    assert live.columns == batch.columns
    assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()
    # more copies later on change nothing
    base.raw_transactions().coalesce(1).write.mode("append").parquet(folder)
    start_latest_status(source(), out, checkpoint).awaitTermination()
    assert live_snapshot(spark, out).exceptAll(batch).isEmpty()


def rows_as(spark, events, *changes):
    """One event of the base, with columns replaced."""
    one = events.orderBy("event_id").limit(1)
    rows = [one.withColumns({k: F.lit(v).cast(one.schema[k].dataType) for k, v in c.items()}) for c in changes]
    return reduce(lambda a, b: a.unionByName(b), rows)


def feed(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_stream_dedupe_is_the_batch_dedupe(spark, base, tmp_path):
    folder, out = str(tmp_path / "events"), str(tmp_path / "out")
    schema = split_events(base, folder)
    start_dedupe(feed(spark, folder, schema), out, str(tmp_path / "ck")).awaitTermination()
    got = deduped(spark, out)
    want = st.dedupe_transactions(base.raw_transactions())
    keys = ["transaction_ref", "event_id"]
    assert got.count() == want.count() == got.select(*keys).distinct().count()
    same = [c for c in want.columns if c != "ingested_at"]
    assert got.select(*same).exceptAll(want.select(*same)).isEmpty()
    # a replay with a new checkpoint adds nothing
    start_dedupe(feed(spark, folder, schema), out, str(tmp_path / "ck2")).awaitTermination()
    assert deduped(spark, out).count() == want.count()


def test_a_late_first_delivery_is_kept(spark, base, tmp_path):
    folder, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    raw = base.raw_transactions()
    early = {"event_id": "a", "event_ts": "2024-01-10 00:00:00"}
    later = {"event_id": "b", "event_ts": "2024-01-11 00:00:00"}
    late = {"event_id": "c", "event_ts": "2023-06-01 00:00:00"}
    for changes in ([early], [later, later], [late], [early, late]):
        rows_as(spark, raw, *changes).coalesce(1).write.mode("append").parquet(folder)
        stream = feed(spark, folder, nullable(TRANSACTION_EVENT))
        start_dedupe(stream, out, ck).awaitTermination()
    assert sorted(r.event_id for r in deduped(spark, out).collect()) == ["a", "b", "c"]


def test_a_retried_batch_keeps_its_events(spark, base, tmp_path):
    out = str(tmp_path / "out")
    rows = base.raw_transactions().limit(50)
    for _ in range(2):
        keep_first_deliveries(rows, "t-1", out)
    assert deduped(spark, out).count() == st.dedupe_transactions(rows).count()


def test_snapshot_after_a_replay_is_the_batch_result(spark, base, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    raw = base.raw_transactions()
    first = {"transaction_ref": "t", "event_id": "e1", "status": "pending", "updated_at": "2024-01-01 00:00:00"}
    second = {**first, "event_id": "e2", "status": "success", "updated_at": "2024-01-02 00:00:00"}
    third = {**first, "event_id": "e3", "status": "reversed", "updated_at": "2024-01-03 00:00:00"}
    schema = nullable(TRANSACTION_EVENT)

    def add(change, checkpoint):
        rows_as(spark, raw, change).coalesce(1).write.mode("append").parquet(folder)
        start_latest_status(feed(spark, folder, schema), out, str(tmp_path / checkpoint)).awaitTermination()

    add(first, "ck")
    add(second, "ck")
    add(third, "ck2")  # a new checkpoint replays all three
    events = spark.read.schema(schema).parquet(folder)
    want = st.latest_status(st.dedupe_transactions(events))
    assert [r.event_id for r in live_snapshot(spark, out).collect()] == ["e3"]
    assert live_snapshot(spark, out).exceptAll(want).isEmpty()


def folders(path, pattern):
    return {str(p): sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in path.glob(pattern)}


def test_a_batch_adds_a_run_and_reads_no_history(spark, base, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    raw = base.raw_transactions()
    merge_latest(raw, out)
    before = folders(tmp_path / "out", "latest/v=*")
    monkeypatch.setattr(live, "_read_runs", lambda *_: pytest.fail("the snapshot was read"))
    merge_latest(rows_as(spark, raw, {"transaction_ref": "new"}), out)
    monkeypatch.undo()
    after = folders(tmp_path / "out", "latest/v=*")
    assert before.items() < after.items() and len(after) == 2
    assert live_snapshot(spark, out).count() == raw.select("transaction_ref").distinct().count() + 1


def test_runs_are_folded_level_by_level(spark, base, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "FOLD", 2)
    latest, first = str(tmp_path / "latest"), str(tmp_path / "first")
    raw = base.raw_transactions().withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(5))).persist()
    for part in range(5):
        batch = raw.where(F.col("part") == part).drop("part")
        merge_latest(batch, latest)
        keep_first_deliveries(batch, f"{part}", first)
    for states in (live._latest_states(spark, latest), live._first_states(spark, first)):
        assert sorted(run["level"] for run in states.live()[1]["runs"]) == [0, 2]
    events = raw.drop("part")
    want = st.latest_status(st.dedupe_transactions(events))
    assert live_snapshot(spark, latest).exceptAll(want).isEmpty()
    assert live_snapshot(spark, latest).count() == want.count()
    assert deduped(spark, first).exceptAll(st.dedupe_transactions(events)).isEmpty()
    raw.unpersist()


def crossing(monkeypatch, other):
    """Another writer commits just before the next commit."""
    real, left = files.create_file, [other]

    def create(spark, path, text):
        if left:
            left.pop()()
        return real(spark, path, text)

    monkeypatch.setattr(files, "create_file", create)


def test_two_writers_on_one_output_lose_and_double_nothing(spark, base, tmp_path, monkeypatch):
    latest, first = str(tmp_path / "latest"), str(tmp_path / "first")
    raw = base.raw_transactions()
    low, high = (rows.persist() for rows in (raw.where("amount_kobo % 2 = 0"), raw.where("amount_kobo % 3 > 0")))
    crossing(monkeypatch, lambda: merge_latest(high, latest))
    merge_latest(low, latest)
    crossing(monkeypatch, lambda: keep_first_deliveries(high, "2", first))
    keep_first_deliveries(low, "1", first)
    both = low.unionByName(high)
    want = st.latest_status(st.dedupe_transactions(both))
    assert live_snapshot(spark, latest).exceptAll(want).isEmpty()
    assert live_snapshot(spark, latest).count() == want.count()
    assert deduped(spark, first).count() == st.dedupe_transactions(both).count()
    assert deduped(spark, first).exceptAll(both).isEmpty()


def test_a_batch_reads_key_buckets_and_no_events(spark, base, tmp_path, monkeypatch):
    """What a small batch reads stays as it is while the history grows twentyfold."""
    monkeypatch.setattr(live, "BUCKET_KEYS", 200)
    raw = rows_as(spark, base.raw_transactions(), {"event_id": "probe"})
    read = {}
    for size in (2_000, 40_000):
        out = str(tmp_path / f"out-{size}")
        history = raw.crossJoin(spark.range(size)).withColumn("event_id", F.concat(F.lit("e"), F.col("id")))
        keep_first_deliveries(history.drop("id"), "0", out)
        _, state = live._first_states(spark, out).live()
        batch = live._hashed(rows_as(spark, raw, {"event_id": "e17"}, {"event_id": "unseen"}))
        keys = live.known_keys(spark, out, state["runs"], batch)
        names = {name.removeprefix("file://") for name in keys.inputFiles()}
        plan = keys._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters" in plan and "key_hash" in plan
        buckets = {r[0] for r in batch.select(F.concat(F.lit("b"), F.substring("key_hash", 1, state["runs"][0]["depth"]))).collect()}
        read[size] = sum(Path(n).stat().st_size for n in names if Path(n).parent.name.removeprefix("bucket=") in buckets)
        history_bytes = sum(folders(tmp_path / f"out-{size}", "keys/v=*").values())
        assert keys.where("event_id = 'e17'").count() == 1 and keys.where("event_id = 'unseen'").count() == 0
        keep_first_deliveries(rows_as(spark, raw, {"event_id": "e17"}, {"event_id": "unseen"}), "1", out)
        assert deduped(spark, out).count() == size + 1
    assert read[40_000] < 3 * read[2_000] and read[40_000] < history_bytes / 50


def test_messages_to_staged_rows(spark, base, tmp_path):
    """JSON messages through the drain give the same staged rows as the events themselves."""
    raw = base.raw_transactions()
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "events.json", "w") as out:
        for line in raw.drop("ingested_at").toJSON().collect():
            out.write(line + "\n")
        out.write("not json\n")
    stats = drain(
        file_messages(spark, str(tmp_path / "in"), "charges"),
        [Dataset("transactions", "charges", TRANSACTION_EVENT)],
        str(tmp_path / "raw"),
        str(tmp_path / "ck"),
    )
    assert stats["transactions"]["written"] == 3072 and stats["transactions"]["malformed"] == 1
    from tallymark.sources.tables import read_raw

    skip = ("processed_at", "ingested_at", "arrival_lag_seconds")
    got = st.stage_transactions(read_raw(spark, str(tmp_path / "raw"), "transactions")).drop(*skip)
    want = st.stage_transactions(raw).drop(*skip)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


# --- Whole run -------------------------------------------------------------------------


def test_nightly_run_twice(spark, base, tmp_path):
    def go(at):
        return run(spark, base.raw_transactions(), base.raw_settlements(), str(tmp_path), at)

    first = go("2024-01-16 00:00:00")
    assert first.staged == {
        "transactions": {"raw": 3072, "staged": 1500},
        "settlements": {"raw": 5358, "staged": 1313},
    }
    assert {t["table"]: t["rows"] for t in first.tables}["mart_settlement_reconciliation"] == 1376
    assert first.cases == {"open": 115, "cleared": 0}
    assert {w["check_name"] for w in first.warnings} == {
        "ngn_amount_discrepancies",
        "usd_rows_with_variance",
    }
    old = read_staged(spark, staged_root(spark, str(tmp_path)), "transactions")
    again = go("2024-01-17 00:00:00")
    assert again.cases == {"open": 115, "cleared": 0}
    assert old.count() == 1500  # a reader of the first run's files is not disturbed


# --- Ledger ----------------------------------------------------------------------------


def test_ledger_skips_committed_chunks_and_records_once(spark, base):
    chunks = fixtures.chunks(base.charges())
    empty = spark.createDataFrame([], nullable(PUBLISH_LEDGER))
    assert lg.pending_chunks(chunks, empty).count() == chunks.count()
    listed = lg.record_chunks(empty, chunks)
    assert lg.pending_chunks(chunks, listed).isEmpty()
    changed = chunks.withColumn("transactions", F.lit(-1).cast("bigint"))
    again = lg.record_chunks(listed, changed.unionByName(changed))
    assert again.exceptAll(listed).isEmpty() and again.count() == listed.count()


# --- Columns and constants -------------------------------------------------------------


def test_money_columns(spark):
    values = [1, -7, 38, 4_060, -91_200, 70_000_003, 2**55 + 3, -(2**55 + 3), 8 * 10**18, 0]
    df = spark.createDataFrame([(v,) for v in values], "kobo bigint")
    got = [r[0] for r in df.select(fn.format_naira(F.col("kobo"))).collect()]
    want = [f"{'-' if v < 0 else ''}{abs(v) // 100:,}.{abs(v) % 100:02d}" for v in values]
    assert got == want

    def fee(amount, channel):
        if channel == "bank_transfer":
            return min(100_000, max(5_000, amount * 5 // 1000))
        return min(amount * 15 // 1000 + (10_000 if amount > 250_000 else 0), 200_000)

    cases = [
        (a, c)
        for a in (0, 7, 667, 249_999, 250_000, 250_001, 3_141_592, 12_666_700, 19_999_999, 7 * 10**8)
        for c in ("card", "bank_transfer", "ussd", "qr")
    ]
    df = spark.createDataFrame(cases, "amount bigint, channel string")
    rows = df.select("*", fn.fee_kobo(F.col("amount"), F.col("channel")).alias("fee")).collect()
    assert all(r["fee"] == fee(r["amount"], r["channel"]) for r in rows)


def test_formats_take_the_whole_text(spark):
    ids = ["a" * 64, "a" * 64 + "\n", "A" * 64, "a" * 63, None]
    df = spark.createDataFrame([(i,) for i in ids], "x string")
    assert [r[0] for r in df.select(fn.valid_case_id(F.col("x"))).collect()] == [True] + [False] * 4
    keys = ["a.b_c:d-", "a" * 128, "a" * 129, "short", "with blank", "abcdefgh\n", None]
    df = spark.createDataFrame([(k,) for k in keys], "x string")
    got = [r[0] for r in df.select(fn.valid_idempotency_key(F.col("x"))).collect()]
    assert got == [True, True, False, False, False, False, False]


def test_drift_is_never_null(spark):
    rows = [
        (None, None, "a:1", False),
        ("CLOSED", "a:1", "a:1", False),
        ("CLOSED", "a:1", "a:2", True),
        ("EXPECTED_DELAY", "a:1", "b:1", True),
        ("ESCALATED", "a:1", "a:2", False),
        ("CLOSED", None, "a:2", False),
    ]
    df = spark.createDataFrame(rows, "s string, d string, c string, want boolean")
    got = df.select(fn.drifted(F.col("s"), F.col("d"), F.col("c")).alias("g"), "want").collect()
    assert all(r["g"] == r["want"] for r in got)


def test_constants():
    assert set(STATUS_RANK) == set(STATUSES) and len(set(STATUS_RANK.values())) == 4
    assert STATUS_RANK["reversed"] > STATUS_RANK["success"] > STATUS_RANK["pending"]
    assert len(TRANSITIONS) == 12
    assert len(TRANSACTION_EVENT) == 19
    assert json.loads(nullable(TRANSACTION_EVENT).json())["fields"][0]["nullable"] is True


def test_work_folder_follows_the_session(spark):
    root = work_root(spark)
    assert root == work_root(spark) and not root.endswith("/")


# --- The gate before publishing --------------------------------------------------------


def all_tables(ws):
    return {
        "stg_transactions": ws.stg_transactions(),
        "stg_settlements": ws.stg_settlements(),
        **ws.tables(),
    }


def test_sound_tables_pass_the_gate(base):
    checks.require_data_tests(all_tables(base))


BREAKAGES = {
    "mart_settlement_reconciliation": (
        fixtures.break_recon,
        ["break_flags", "matched_with_outstanding", "inconsistent_matched", "stale_but_missing"]
        + ["not_null_reconciliation_status", "accepted_break_type"],
    ),
    "stg_transactions": (
        fixtures.break_stg_transactions,
        ["not_null_merchant_id", "accepted_status", "accepted_currency"],
    ),
    "fct_transactions": (
        fixtures.break_fct_transactions,
        ["negative_money", "usd_without_rate"],
    ),
    "fct_settlements": (fixtures.break_fct_settlements, ["settled_before_charge"]),
    "mart_merchant_daily": (fixtures.break_success_rate, ["success_rate_range"]),
    "mart_channel_performance": (fixtures.break_success_rate, ["success_rate_range"]),
}


@pytest.mark.parametrize("table", list(BREAKAGES))
def test_every_broken_rule_stops_the_gate(base, table):
    broken, rules = BREAKAGES[table]
    tables = all_tables(base)
    with pytest.raises(RuntimeError) as failed:
        checks.require_data_tests({**tables, table: broken(tables[table])})
    for rule in rules:
        assert f"{table}.{rule}=" in str(failed.value)


def test_copies_orphans_and_lost_rows_stop_the_gate(base):
    tables = all_tables(base)
    fct, lines, daily = (tables[t] for t in ("fct_transactions", "stg_settlements", "mart_merchant_daily"))
    for table, rows, rule in (
        ("fct_transactions", fct.unionByName(fct.limit(3)), "unique_transaction_ref"),
        ("stg_settlements", lines.withColumn("transaction_ref", F.lit("TX_0")), "line_has_charge"),
        ("mart_merchant_daily", daily.limit(1), "ties_to_fact"),
    ):
        with pytest.raises(RuntimeError, match=rf"{table}\.{rule}="):
            checks.require_data_tests({**tables, table: rows})


def test_a_closed_gate_leaves_the_old_version_live(spark, base, tmp_path):
    root, marts = str(tmp_path), {"mart_merchant_daily": base.daily}
    (old,) = publish_all(marts, root)

    def closed(drafts):
        assert drafts["mart_merchant_daily"].count() == base.daily.count()
        raise RuntimeError("closed")

    with pytest.raises(RuntimeError, match="closed"):
        publish_all(marts, root, gate=closed)
    assert live_versions(spark, root)["mart_merchant_daily"] == old["version"]
    assert len(list((tmp_path / "mart_merchant_daily").glob("v=*"))) == 1


def test_the_serving_report_reads_each_table_once(spark, base):
    tables = base.tables()
    rows = {name: df.count() for name, df in tables.items()}
    report = checks.serving_report(tables, rows)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert sum("parquet" in line for line in plan.splitlines()) == 3
    counted = checks.serving_report(tables)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, counted.collect()))
