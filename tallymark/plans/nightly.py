"""One run over the raw layer: staged, facts and marts, publish, checks, cases."""

from __future__ import annotations

import logging
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import checks, marts, staging
from tallymark.operators.reconcile import reconcile_by_reference
from tallymark.session import use_utc
from tallymark.sources.case_store import CaseStore
from tallymark.sources.by_reference import ByReference, drop_by_reference, write_by_reference
from tallymark.sources.files import read_marker, write_marker
from tallymark.sources.publish import (
    MARTS,
    drop_old_folders,
    drop_old_versions,
    publish_all,
    served,
)
from tallymark.sources.tables import read_staged, write_staged

log = logging.getLogger(__name__)

#: Versions of staged tables and marts that stay, the live one among them.
KEEP_VERSIONS = 3


@dataclass
class RunReport:
    staged: dict[str, int] = field(default_factory=dict)
    tables: list[dict] = field(default_factory=list)
    warnings: list[dict] = field(default_factory=list)
    cases: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def stage(raw: DataFrame, dataset: str, root: str) -> dict[str, int]:
    """Raw to staged in one job; rows in and out are observed while it runs."""
    seen, kept = Observation(), Observation()
    count = F.count(F.lit(1)).alias("rows")
    build = {
        "transactions": staging.stage_transactions,
        "settlements": staging.stage_settlements,
    }[dataset]
    write_staged(build(raw.observe(seen, count)).observe(kept, count), root, dataset)
    rows_in, rows_out = seen.get["rows"], kept.get["rows"]
    if rows_out == 0:
        raise RuntimeError(f"staged {dataset} is empty; refusing to succeed")
    if rows_in == rows_out:
        log.warning("%s: no duplicates removed; check the source and the key", dataset)
    return {"raw": rows_in, "staged": rows_out}


def staged_root(spark: SparkSession, root: str) -> str:
    """Folder of the last completed staging."""
    version = read_marker(spark, f"{root}/staged")
    if version is None:
        raise FileNotFoundError(f"nothing has been staged under {root}")
    return f"{root}/staged/{version}"


def build_marts(stg_tx: DataFrame, layout: ByReference) -> dict[str, DataFrame]:
    """What joins charges and lines reads them where they lie together, the rest by day."""
    return {
        "fct_transactions": marts.fct_transactions(stg_tx),
        "fct_settlements": marts.fct_settlements_by_reference(layout),
        "mart_settlement_reconciliation": reconcile_by_reference(layout),
        "mart_merchant_daily": marts.mart_merchant_daily(stg_tx),
        "mart_channel_performance": marts.mart_channel_performance(stg_tx),
    }


def run(
    spark: SparkSession,
    raw_transactions: DataFrame,
    raw_settlements: DataFrame,
    root: str,
    run_at: str,
) -> RunReport:
    """Every step reads what the one before has written. Staged rows go to a new
    version under `root/staged`, marts to `root/marts`, cases to `root/cases`. Marts go live
    only if all data tests hold on their drafts. KEEP_VERSIONS of each are kept."""
    use_utc(spark)
    report = RunReport()

    def timed(name: str, step):
        started = time.time()
        result = step()
        report.seconds[name] = round(time.time() - started, 3)
        return result

    # a fresh folder per run: whoever still reads the last run's staged files keeps them
    version = f"v={uuid.uuid4().hex}"
    stage_to, mart_root = f"{root}/staged/{version}", f"{root}/marts"

    raw = {"transactions": raw_transactions, "settlements": raw_settlements}

    def stage_both() -> None:
        with ThreadPoolExecutor(max_workers=len(raw)) as pool:
            counts = pool.map(lambda name: stage(raw[name], name, stage_to), raw)
            report.staged.update(zip(raw, counts, strict=True))

    timed("raw_to_staged", stage_both)
    write_marker(spark, f"{root}/staged", version)
    stg_tx = staging.stg_transactions(read_staged(spark, stage_to, "transactions"))
    stg_stl = staging.stg_settlements(read_staged(spark, stage_to, "settlements"))
    staged = {"stg_transactions": stg_tx, "stg_settlements": stg_stl}
    joined = f"{root}/by_reference/{version}"

    def marts_and_publish() -> list[dict]:
        layout = write_by_reference(stg_tx, stg_stl, joined)
        return publish_all(
            build_marts(stg_tx, layout),
            mart_root,
            gate=lambda drafts: checks.require_data_tests({**staged, **drafts}),
        )

    report.tables = timed("marts_and_publish", marts_and_publish)
    drop_by_reference(spark, joined)
    live = served(spark, mart_root)
    rows = {table["table"]: table["rows"] for table in report.tables}
    _, soft = timed("checks", lambda: checks.enforce(checks.serving_report(live, rows)))
    report.warnings = [row.asDict() for row in soft]
    store = CaseStore(spark, f"{root}/cases")
    report.cases = timed(
        "case_sync",
        lambda: store.sync_mart(
            live["mart_settlement_reconciliation"], F.lit(run_at).cast("timestamp")
        ),
    )
    for name in MARTS:
        drop_old_versions(spark, mart_root, name, KEEP_VERSIONS)
    drop_old_folders(spark, f"{root}/staged", KEEP_VERSIONS)
    drop_old_folders(spark, f"{root}/by_reference", KEEP_VERSIONS)
    return report
