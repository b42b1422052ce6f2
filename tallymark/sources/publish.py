"""Publishing marts for readers.

A version of a table is written next to the live one. Which version of each table is live
stands in one small numbered file, the manifest; a run writes all its versions first and then
creates the next manifest, so readers see the tables of one run or of the one before, never a
mix and never an empty table. A manifest is only created by who has read the one before: two
publishers at a time cannot undo each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymark.sources import files
from tallymark.sources.states import States


@dataclass(frozen=True)
class MartSpec:
    """How the files of a table lie. `order` sorts inside a file, so that a reader who filters
    by its first columns skips row groups; `month` names the date that folders go by; a table
    that `comes_by_day` from the staged files is not dealt out again."""

    name: str
    order: tuple[str, ...]
    month: str | None = None
    comes_by_day: bool = False


# Tables, their sort keys and the dates of their monthly folders.
MARTS = {
    "fct_transactions": MartSpec(
        "fct_transactions", ("event_date", "merchant_id", "transaction_ref"), "event_date", True
    ),
    "fct_settlements": MartSpec(
        "fct_settlements", ("settlement_date", "merchant_id", "settlement_id"), "settlement_date"
    ),
    "mart_settlement_reconciliation": MartSpec(
        "mart_settlement_reconciliation",
        ("reconciliation_bucket", "merchant_id", "succeeded_date", "transaction_ref"),
    ),
    "mart_merchant_daily": MartSpec("mart_merchant_daily", ("event_date", "merchant_id")),
    "mart_channel_performance": MartSpec(
        "mart_channel_performance", ("event_date", "channel", "bank_code")
    ),
}

#: Manifests kept for readers that still hold an older one, with the versions they name.
KEEP_RUNS = 3


def mart_spec(name: str) -> MartSpec:
    if name not in MARTS:
        raise ValueError(f"no mart named {name!r}; known: {sorted(MARTS)}")
    return MARTS[name]


def laid_out(df: DataFrame, spec: MartSpec) -> DataFrame:
    """Sort each output file by the mart's key, so its row groups can be skipped.

    A mart without months keeps the partitions it was computed in: no extra shuffle, and
    no sampling pass, which a range partitioning would need. So does one whose input comes
    grouped by day from the staged files. Otherwise the rows are rebalanced by day, which
    keeps the number of files per month low; a day that holds most of the rows is split
    over tasks at run time.
    """
    if spec.month is None:
        return df.sortWithinPartitions(*spec.order)
    dated = df.withColumn("month", F.date_format(spec.month, "yyyyMM"))
    if not spec.comes_by_day:
        dated = dated.hint("rebalance", spec.month)
    return dated.sortWithinPartitions("month", *spec.order)


def write_version(df: DataFrame, path: str, month: bool = False) -> int:
    """Write one version and return its rows, counted while writing."""
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if month:
        writer = writer.partitionBy("month")
    writer.parquet(path)
    return counted.get["rows"]


def write_draft(df: DataFrame, name: str, root: str) -> dict:
    """Write a version nobody reads yet; an empty one is refused."""
    spec = mart_spec(name)
    version = f"v={uuid.uuid4().hex}"
    rows = write_version(
        laid_out(df, spec), f"{root}/{name}/{version}", month=spec.month is not None
    )
    if rows == 0:
        raise RuntimeError(f"{name}: 0 rows written; refusing to replace live data")
    return {"table": name, "version": version, "rows": rows}


def read_version(spark: SparkSession, root: str, name: str, version: str) -> DataFrame:
    """One version of a table. The schema comes from its files."""
    return spark.read.parquet(f"{root}/{name}/{version}").drop("month")


def manifest(spark: SparkSession, root: str) -> States:
    """The manifests under `root`: which version of each table is live."""

    def versions(state: dict) -> list[str]:
        return [f"{table}/{version}" for table, version in state["tables"].items()]

    return States(spark, root, {"tables": {}}, versions, KEEP_RUNS)


def _go_live(spark: SparkSession, drafts: list[dict], root: str, view: bool) -> None:
    """Make the drafts live, all at once."""
    new = {draft["table"]: draft["version"] for draft in drafts}
    manifest(spark, root).change(lambda state: ({"tables": {**state["tables"], **new}}, None), keep_drafts=True)
    if view:
        for name, df in served(spark, root, list(new)).items():
            df.createOrReplaceTempView(name)


def _drop_drafts(spark: SparkSession, drafts: list[dict], root: str) -> None:
    for draft in drafts:
        files.delete_path(spark, f"{root}/{draft['table']}/{draft['version']}")


def publish(df: DataFrame, name: str, root: str, view: bool = True) -> dict:
    """Publish one mart. Returns its name, rows and version."""
    draft = write_draft(df, name, root)
    _go_live(df.sparkSession, [draft], root, view)
    return draft


def publish_all(
    marts: dict[str, DataFrame],
    root: str,
    only: str | None = None,
    gate: Callable[[dict[str, DataFrame]], None] | None = None,
) -> list[dict]:
    """Publish the marts, or one of them by name. They do not depend on each other, so
    their jobs share the cluster: the tail of one overlaps the start of the next.

    All drafts are written before anything goes live. The gate reads them and raises to stop:
    then the drafts are removed and readers keep what they have. Otherwise one manifest names
    them all.
    """
    if only is not None:
        mart_spec(only)
    chosen = {name: df for name, df in marts.items() if only in (None, name)}
    if not chosen:
        return []
    spark = next(iter(chosen.values())).sparkSession
    with ThreadPoolExecutor(max_workers=len(chosen)) as pool:
        drafts = list(pool.map(lambda item: write_draft(item[1], item[0], root), chosen.items()))
    if gate is not None:
        try:
            gate({d["table"]: read_version(spark, root, d["table"], d["version"]) for d in drafts})
        except Exception:
            _drop_drafts(spark, drafts, root)
            raise
    _go_live(spark, drafts, root, view=True)
    return drafts


def live_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """Table to live version, of one manifest."""
    return manifest(spark, root).live()[1]["tables"]


def served(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The published tables, or some by name, all as one manifest has them."""
    versions = live_versions(spark, root)
    for name in versions if names is None else names:
        mart_spec(name)
        if name not in versions:
            raise FileNotFoundError(f"{name} has never been published under {root}")
    return {name: read_version(spark, root, name, versions[name]) for name in names or versions}


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of one published table."""
    return served(spark, root, [name])[name]


def drop_old_versions(spark: SparkSession, root: str, name: str, keep: int = KEEP_RUNS) -> int:
    """Remove versions of a table that no kept manifest names, as a run that died leaves them;
    the newest `keep` stay, they may be drafts of a run that is still going."""
    named = manifest(spark, root).named()
    found = files.list_by_age(spark, f"{root}/{name}", "v=")
    old = [version for version in found[keep:] if f"{name}/{version}" not in named]
    for version in old:
        files.delete_path(spark, f"{root}/{name}/{version}")
    return len(old)


def drop_old_folders(spark: SparkSession, folder: str, keep: int) -> int:
    """Remove versions beyond the newest `keep` of a folder with a marker; the marked one stays."""
    live = files.read_marker(spark, folder)
    old = [version for version in files.list_by_age(spark, folder, "v=")[keep:] if version != live]
    for version in old:
        files.delete_path(spark, f"{folder}/{version}")
    return len(old)
