"""The case snapshot and the audit log on a file store.

The state is a small numbered file that names the live snapshot and the segments of the log.
A change reads state n, writes its files under fresh names and then creates state n + 1,
which only succeeds if nobody else has: then the change starts again from the newer state.
So no writer overwrites another's work, a failed change leaves the old state, and the state
of a case and the actions behind it can never come apart.

The snapshot is a base and the rows that actions have changed since: applying requests reads and
writes the cases they name, not the table. A sync writes a new base, and so does every
FOLD_CHANGES-th change.

The log is a set of segments; applying requests adds one and rewrites nothing. Each segment has a
fingerprint of its rows, which does not care for their order, and the fingerprints are chained by
digests: the state holds the chain, so whether a segment is still what was appended is seen from
that segment alone, and a compacted log is compared by sums of fingerprints, without its old rows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.operators import cases as cs
from tallymark.operators import checks as ck
from tallymark.operators.actions import AppliedActions, apply_actions
from tallymark.schemas import BREAK, CASE, CASE_ACTION, nullable
from tallymark.sources.files import delete_path
from tallymark.sources.states import States
from tallymark.sources.tables import materialize

#: cases, changes: the base of the snapshot and the rows changed since, oldest first.
#: links: for each segment its rows, the sums of their hashes and the digest of the chain so far.
EMPTY = {"cases": None, "changes": [], "segments": [], "links": []}

#: States kept for readers that still hold an older one, with the snapshots they name.
KEEP_STATES = 3

#: Changes of a base that readers merge before they are folded into a new one.
FOLD_CHANGES = 8


def _refuse(violations: DataFrame, what: str) -> None:
    found = violations.limit(5).collect()
    if found:
        raise ValueError(f"{what}: {[r.asDict() for r in found]}")


# --- fingerprints of the log


def _print_columns() -> list[Column]:
    """Rows and two sums of 64-bit hashes over all columns. A null has a mark of its own, since
    the hash alone passes over it."""
    values = [F.col(c) for c in CASE_ACTION.names]
    marks = [F.col(c).isNull() for c in CASE_ACTION.names]
    halves = [F.xxhash64(*marks, *values), F.xxhash64(F.lit("other half"), *marks, *values)]
    sums = [F.sum(half.cast("decimal(38,0)")) for half in halves]
    return [F.count(F.lit(1)).alias("rows"), *[s.alias(f"sum_{i}") for i, s in enumerate(sums)]]


def _as_print(row: dict) -> dict:
    return {"rows": row["rows"], "sums": [str(row[f"sum_{i}"] or 0) for i in range(2)]}


def _chained(before: str, link: dict) -> str:
    text = json.dumps([before, link["rows"], link["sums"]])
    return hashlib.sha256(text.encode()).hexdigest()


def _head(links: list[dict]) -> str:
    return links[-1]["digest"] if links else ""


def _total(links: list[dict]) -> dict:
    sums = [str(sum(int(link["sums"][i]) for link in links)) for i in range(2)]
    return {"rows": sum(link["rows"] for link in links), "sums": sums}


@dataclass(frozen=True)
class CaseStore:
    spark: SparkSession
    root: str

    # --- state

    @property
    def states(self) -> States:
        return States(self.spark, self.root, EMPTY, self._files, KEEP_STATES)

    @staticmethod
    def _files(state: dict) -> list[str]:
        return [f for f in (state["cases"], *state["changes"], *state["segments"]) if f]

    # --- reading

    def _read(self, paths: list[str], schema: StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], nullable(schema))
        full = [f"{self.root}/{path}" for path in paths]
        return self.spark.read.schema(nullable(schema)).parquet(*full).select(*schema.names)

    def _cases(self, state: dict) -> DataFrame:
        base = self._read([state["cases"]] if state["cases"] else [], CASE)
        if not state["changes"]:
            return base
        parts = [
            self._read([name], CASE).withColumn("_turn", F.lit(turn)) for turn, name in enumerate(state["changes"])
        ]
        newest = reduce(DataFrame.unionByName, parts).groupBy("case_id").agg(
            F.max_by(F.struct(*CASE.names), "_turn").alias("row")
        )
        kept = base.join(newest.select("case_id"), "case_id", "anti")
        return kept.select(*CASE.names).unionByName(newest.select("row.*"))

    def cases(self) -> DataFrame:
        return self._cases(self.states.live()[1])

    def actions(self) -> DataFrame:
        return self._read(self.states.live()[1]["segments"], CASE_ACTION)

    def effective(self) -> DataFrame:
        return cs.effective_cases(self.cases())

    def case(self, case_id: str) -> DataFrame:
        _, state = self.states.live()  # both from one state
        effective = cs.effective_cases(self._cases(state))
        return cs.case_with_actions(
            effective, self._read(state["segments"], CASE_ACTION), F.lit(case_id)
        )

    # --- writing

    def _draft_cases(self, cases: DataFrame) -> str:
        """Write a new snapshot that nobody reads yet, and check it. Rules on single rows are counted
        while it is written."""
        name, seen = f"cases/v={uuid.uuid4().hex}", Observation()
        counted = cases.select(*CASE.names).observe(seen, ck.broken_cases().alias("broken"))
        counted.write.parquet(f"{self.root}/{name}")
        written = self._read([name], CASE)
        try:
            if seen.get["broken"]:
                _refuse(ck.case_constraint_violations(written), "case constraint violated")
            _refuse(ck.case_key_violations(written), "case key is not unique")
        except ValueError:
            delete_path(self.spark, f"{self.root}/{name}")
            raise
        return name

    def _draft_segment(self, rows: DataFrame) -> tuple[str, dict]:
        """Write a segment; its name and its fingerprint, taken while it is written."""
        name, seen = f"log/segment={uuid.uuid4().hex}", Observation()
        rows = rows.select(*CASE_ACTION.names).observe(seen, *_print_columns())
        rows.write.parquet(f"{self.root}/{name}")
        return name, _as_print(seen.get)

    # --- the log as a chain

    def verify_segment(self, number: int) -> None:
        """Raise unless a segment still has the fingerprint it was appended with. Reads no other."""
        _, state = self.states.live()
        link = state["links"][number]
        rows = self._read([state["segments"][number]], CASE_ACTION)
        found = _as_print(rows.agg(*_print_columns()).first().asDict())
        if found != {"rows": link["rows"], "sums": link["sums"]}:
            raise ValueError(f"the audit log is append-only: segment {number} is not what was appended")

    def verify_chain(self) -> str:
        """Raise unless every digest follows from the one before; the last digest. Reads no rows."""
        _, state = self.states.live()
        before = state["links"][0]["before"] if state["links"] else ""
        for number, link in enumerate(state["links"]):
            if link["before"] != before or _chained(before, link) != link["digest"]:
                raise ValueError(f"the audit log is append-only: the chain breaks at segment {number}")
            before = link["digest"]
        return before

    @staticmethod
    def _linked(before: str, found: dict) -> dict:
        return {**found, "before": before, "digest": _chained(before, found)}

    def sync(self, breaks: DataFrame, run_at: Column) -> dict:
        """Reconcile the system columns with the latest breaks."""
        breaks = breaks.select(*BREAK.names)

        def build(state: dict) -> tuple[dict, dict]:
            before = self._cases(state)
            counts = cs.sync_counts(before, breaks).first()
            if counts["repeated"]:
                _refuse(ck.check_unique(breaks, "case_id"), "a case occurs twice in the break feed")
            draft = self._draft_cases(cs.sync_cases(before, breaks, run_at))
            done = {"open": counts["current_breaks"], "cleared": counts["newly_cleared"]}
            return {**state, "cases": draft, "changes": []}, done

        return self.states.change(build)

    def sync_mart(self, recon: DataFrame, run_at: Column) -> dict:
        """Sync from the mart itself; an empty mart is a failed load and is refused."""
        cs.require_mart_rows(recon)
        return self.sync(cs.break_feed(recon), run_at)

    def apply(self, requests: DataFrame) -> AppliedActions:
        """Apply analyst requests and append the accepted ones to the audit log. Only the cases that
        requests name are read on, and only those with an accepted action are written; `cases` of
        the result holds the former."""

        def build(state: dict) -> tuple[dict, AppliedActions]:
            cases, log = self._cases(state), self._read(state["segments"], CASE_ACTION)
            named = requests.select("case_id").distinct()
            cases = materialize(cases.join(named, "case_id", "semi"), "named-cases")
            applied = apply_actions(cases, requests, log)
            _refuse(ck.action_constraint_violations(applied.recorded), "action constraint violated")
            _refuse(
                ck.action_key_violations(applied.recorded, cases), "action key constraint violated"
            )
            segment, found = self._draft_segment(applied.recorded)
            links = [*state["links"], self._linked(_head(state["links"]), found)]
            after = {**state, "segments": [*state["segments"], segment], "links": links}
            if found["rows"]:
                acted = self._read([segment], CASE_ACTION).select("case_id").distinct()
                changed = self._draft_cases(applied.cases.join(acted, "case_id", "semi"))
                after["changes"] = [*state["changes"], changed]
            if len(after["changes"]) >= FOLD_CHANGES:
                after |= {"cases": self._draft_cases(self._cases(after)), "changes": []}
            return after, applied

        return self.states.change(build)

    def replace_log(self, new_log: Callable[[DataFrame], DataFrame] | DataFrame) -> None:
        """Rewrite the log, to compact or extend it. It must hold every old row unchanged: a
        log that misses rows added meanwhile is refused. Given a function of the old log, it
        is applied again to what the log holds by then.

        A compacted log has the summed fingerprint of its segments and needs no other proof; only
        one that has more rows is compared row by row. The chain goes on from its last digest.
        """

        def build(state: dict) -> tuple[dict, None]:
            old = self._read(state["segments"], CASE_ACTION)
            segment, found = self._draft_segment(new_log(old) if callable(new_log) else new_log)
            if found != _total(state["links"]):
                new = self._read([segment], CASE_ACTION)
                try:
                    if found["rows"] <= _total(state["links"])["rows"]:
                        raise ValueError("the audit log is append-only: rows are missing or changed")
                    _refuse(ck.removed_audit_rows(old, new), "the audit log is append-only")
                except ValueError:
                    delete_path(self.spark, f"{self.root}/{segment}")
                    raise
            links = [self._linked(_head(state["links"]), found)]
            return {**state, "segments": [segment], "links": links}, None

        self.states.change(build)
