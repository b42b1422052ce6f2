"""Headline timings: one nightly run step by step, then single operators and reports.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Raw events are derived from the given tables and written once before the clock starts,
as the raw layer an ingest would have left. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import functions as F

from tallymark.operators import checks, fingerprints, marts, reports, staging
from tallymark.operators.actions import apply_actions
from tallymark.operators.coerce import accepted, coerce
from tallymark.operators.reconcile import reconcile, reconcile_by_reference
from tallymark.plans import fixtures
from tallymark.plans.nightly import run, staged_root
from tallymark.plans.workspace import Workspace
from tallymark.schemas import TRANSACTION_EVENT
from tallymark.session import local_session, scratch
from tallymark.sources.by_reference import write_by_reference
from tallymark.sources.case_store import CaseStore
from tallymark.sources.publish import published
from tallymark.sources.tables import materialize, read_staged

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> int:
    spark = local_session(CPUS, "tallymark-bench")
    spark.sparkContext.setLogLevel("ERROR")
    ws = Workspace(spark, SF_DIR, faulty=False)
    # a raw layer is many files; the given tables are one file each
    raw_tx = materialize(ws.raw_transactions().repartition(2 * int(CPUS)), "raw-transactions")
    raw_stl = materialize(ws.raw_settlements().repartition(2 * int(CPUS)), "raw-settlements")
    messages = materialize(ws.messages().repartition(2 * int(CPUS)), "messages")
    root = scratch(spark, "bench")
    times: dict[str, float] = {}

    def timed(name, step):
        started = time.perf_counter()
        result = step()
        times[name] = round(time.perf_counter() - started, 3)
        return result

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    # --- the nightly run, cold
    report = run(spark, raw_tx, raw_stl, root, "2024-01-16 00:00:00")
    times.update(report.seconds)
    headline = round(sum(times.values()), 3)

    stg_tx = staging.stg_transactions(read_staged(spark, staged_root(spark, root), "transactions"))
    stg_stl = staging.stg_settlements(read_staged(spark, staged_root(spark, root), "settlements"))
    recon = published(spark, f"{root}/marts", "mart_settlement_reconciliation")
    store = CaseStore(spark, f"{root}/cases")

    # --- the same again, warm
    again = run(spark, raw_tx, raw_stl, root, "2024-01-17 00:00:00")
    times.update({f"{name}_warm": seconds for name, seconds in again.seconds.items()})

    # --- single operators, warm
    log = fixtures.action_log(fixtures.first_breaks(recon))
    timed("apply_actions", lambda: noop(apply_actions(store.cases(), log).outcomes))
    timed("dedupe_and_collapse", lambda: noop(staging.stage_transactions(raw_tx)))
    timed("fct_settlements", lambda: noop(marts.fct_settlements(stg_stl, stg_tx)))
    timed("reconcile", lambda: noop(reconcile(stg_tx, stg_stl)))
    layout = timed(
        "write_by_reference", lambda: write_by_reference(stg_tx, stg_stl, scratch(spark, "by-reference"))
    )
    timed("reconcile_by_reference", lambda: noop(reconcile_by_reference(layout)))
    timed("fct_settlements_by_reference", lambda: noop(marts.fct_settlements_by_reference(layout)))
    timed("merchant_daily", lambda: noop(marts.mart_merchant_daily(stg_tx)))
    timed("channel_performance", lambda: noop(marts.mart_channel_performance(stg_tx)))
    timed("status_breakdown", lambda: noop(reports.reconciliation_breakdown(recon)))
    timed("merchant_health", lambda: noop(reports.merchant_health(recon)))
    timed("oldest_unsettled", lambda: noop(reports.oldest_unsettled(recon)))
    timed("compare_bags", lambda: noop(checks.compare_bags(raw_tx, raw_tx, "event_id")))
    timed("compare_bags_by_ranges", lambda: noop(fingerprints.differing_ranges(raw_tx, raw_tx, "event_id")))
    # what a typed read without any check costs on the same messages
    typed = F.from_json(F.col("value").cast("string"), TRANSACTION_EVENT).alias("record")
    timed("plain_from_json", lambda: noop(messages.select(typed).select("record.*")))
    stamp = F.lit("2024-01-15 06:00:00")
    timed(
        "coerce_messages",
        lambda: noop(accepted(coerce(messages, TRANSACTION_EVENT), TRANSACTION_EVENT, stamp)),
    )

    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "nightly run, raw layer to synced cases",
                "value": headline,
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
