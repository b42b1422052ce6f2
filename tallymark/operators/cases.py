"""Break cases: the feed, the sync with the latest run, the views and the queue.

A case has two owners. The sync writes system columns, analysts write the analyst
columns, and neither touches the other's. The status a person sees is derived.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions import display_id, drifted, effective_status, fingerprint
from tallymark.schemas import BREAK, CASE, QUEUE_VIEWS

# Facts that follow the latest run. The rest of a case keeps its first-seen values.
REFRESHED = (
    "break_type",
    "exposure_kobo",
    "amount_ngn_kobo",
    "expected_net_kobo",
    "settled_net_kobo",
    "system_fingerprint",
)
FIRST_SEEN = (
    "display_id",
    "transaction_ref",
    "merchant_id",
    "channel",
    "gateway",
    "bank_code",
    "currency",
    "succeeded_date",
)
QUEUE_ORDER = ("exposure_kobo", "succeeded_date", "case_id")


def break_feed(recon: DataFrame) -> DataFrame:
    return recon.where(F.col("is_break")).select(*BREAK.names)


def sync_cases(cases: DataFrame, breaks: DataFrame, run_at: Column) -> DataFrame:
    """The next case snapshot: open new breaks, refresh known ones, clear absent ones.

    Both sides have one row per case_id, so the full outer merge has no hot key.
    """
    run_at = run_at.cast("timestamp")
    incoming = breaks.select(
        "*",
        display_id(F.col("case_id")).alias("display_id"),
        fingerprint(F.col("break_type"), F.col("exposure_kobo")).alias("system_fingerprint"),
    )
    old, new = cases.alias("old"), incoming.alias("new")
    merged = old.join(new, F.col("old.case_id") == F.col("new.case_id"), "full_outer")
    known, present = F.col("old.case_id").isNotNull(), F.col("new.case_id").isNotNull()
    clears = known & ~present & (F.col("old.system_status") == "OPEN")

    columns = {"case_id": F.coalesce("new.case_id", "old.case_id")}
    for c in FIRST_SEEN:
        columns[c] = F.when(known, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}"))
    for c in REFRESHED:
        columns[c] = F.when(present, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
    columns["system_status"] = F.when(present, "OPEN").otherwise("CLEARED")
    columns["analyst_status"] = F.col("old.analyst_status")
    columns["decided_fingerprint"] = F.col("old.decided_fingerprint")
    columns["first_seen_at"] = F.when(known, F.col("old.first_seen_at")).otherwise(run_at)
    columns["last_seen_at"] = F.when(present, run_at).otherwise(F.col("old.last_seen_at"))
    columns["updated_at"] = F.when(present | clears, run_at).otherwise(F.col("old.updated_at"))
    return merged.select(*[columns[c].alias(c) for c in CASE.names])


def sync_counts(before: DataFrame, breaks: DataFrame) -> DataFrame:
    """(current_breaks, newly_cleared, repeated) of a sync, from one grouping by case: breaks,
    open cases without one, and cases that the feed holds more than once."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    was_open = before.where(F.col("system_status") == "OPEN")
    sides = was_open.select("case_id", one.alias("was_open"), none.alias("now")).unionByName(
        breaks.select("case_id", none.alias("was_open"), one.alias("now"))
    )
    cases = sides.groupBy("case_id").agg(F.sum("was_open").alias("was_open"), F.sum("now").alias("now"))
    return cases.agg(
        F.coalesce(F.sum("now"), none).alias("current_breaks"),
        F.count_if((F.col("was_open") > 0) & (F.col("now") == 0)).alias("newly_cleared"),
        F.count_if((F.col("now") > 1) & F.col("case_id").isNotNull()).alias("repeated"),
    )


def require_mart_rows(recon: DataFrame) -> None:
    """An empty mart means a failed load, not that every break was fixed."""
    if recon.isEmpty():
        raise RuntimeError("the reconciliation mart is empty; refusing to clear cases")


def effective_cases(cases: DataFrame) -> DataFrame:
    analyst = F.col("analyst_status")
    return cases.withColumns(
        {
            "effective_status": effective_status(analyst, F.col("system_status")),
            "drifted": drifted(
                analyst, F.col("decided_fingerprint"), F.col("system_fingerprint")
            ),
        }
    )


def in_view(view: str) -> Column:
    status, moved = F.col("effective_status"), F.col("drifted")
    predicates = {
        "active": ~status.isin("CLOSED", "CLEARED") | moved,
        "closed": (status == "CLOSED") & ~moved,
        "cleared": status == "CLEARED",
        "all": F.lit(True),
    }
    if view not in QUEUE_VIEWS:
        raise ValueError(f"no view named {view!r}; known: {QUEUE_VIEWS}")
    return predicates[view]


def _filtered(effective: DataFrame, view: str, break_type: str | None) -> DataFrame:
    rows = effective.where(in_view(view))
    return rows if break_type is None else rows.where(F.col("break_type") == break_type)


def queue_page(
    effective: DataFrame,
    view: str = "active",
    break_type: str | None = None,
    limit: int = 50,
    offset: int = 0,
) -> DataFrame:
    """One page of the queue, largest exposure first, then oldest."""
    exposure, day, key = QUEUE_ORDER
    return (
        _filtered(effective, view, break_type)
        .orderBy(F.desc(exposure), F.asc(day), F.asc(key))
        .offset(offset)
        .limit(limit)
    )


def queue_total(
    effective: DataFrame, view: str = "active", break_type: str | None = None
) -> DataFrame:
    return _filtered(effective, view, break_type).agg(F.count("*").alias("total"))


def view_counts(effective: DataFrame) -> DataFrame:
    """Cases per queue view, in one pass."""
    counts = effective.agg(*[F.count_if(in_view(v)).alias(v) for v in QUEUE_VIEWS])
    return counts.unpivot([], list(QUEUE_VIEWS), "queue_view", "cases")


def active_summary(effective: DataFrame) -> DataFrame:
    """Active cases and exposure by break type, largest exposure first."""
    return (
        effective.where(in_view("active"))
        .groupBy("break_type")
        .agg(F.count("*").alias("cases"), F.sum("exposure_kobo").alias("exposure_kobo"))
        .orderBy(F.desc("exposure_kobo"), "break_type")
    )


def queue_summary(effective: DataFrame) -> DataFrame:
    """Totals of the console header."""
    active = in_view("active")
    return effective.agg(
        F.count_if(active).alias("active_cases"),
        F.coalesce(F.sum(F.when(active, F.col("exposure_kobo"))), F.lit(0).cast("bigint")).alias(
            "active_exposure_kobo"
        ),
        F.count_if(F.col("drifted")).alias("drifted_cases"),
    )


def case_with_actions(effective: DataFrame, actions: DataFrame, case_id: Column) -> DataFrame:
    """One case with its recorded actions in order; a case without any is one row."""
    case = effective.where(F.col("case_id") == case_id)
    log = actions.where(F.col("case_id") == case_id).select(
        "case_id", "action_id", "analyst", "action", "notes", "resulting_status"
    )
    return case.join(log, "case_id", "left").orderBy("action_id")
