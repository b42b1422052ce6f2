"""Tables shared by the registered queries, each built once per session and input.

Staged tables and marts are written to the shared work folder and read back, as a
nightly run does, so a report costs one scan of a mart instead of the whole history
behind it. Raw events stay lazy: they are derived from the given tables on every use.
They are made dealt by reference, and the staged tables and the lines of the facts stay so:
joins by reference move nothing. An order has a few lines, so no bucket has a hot reference.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators import marts, staging
from tallymark.operators.actions import AppliedActions, apply_actions
from tallymark.operators.cases import effective_cases, sync_cases
from tallymark.operators.reconcile import reconcile
from tallymark.plans import fixtures
from tallymark.schemas import CASE, nullable
from tallymark.session import scratch, use_utc
from tallymark.sources.by_reference import ByReference, write_by_reference
from tallymark.sources.queue import RANGE_CASES, Queue
from tallymark.sources.tables import STAGED, materialize, materialize_by, read_staged, write_staged

MARTS = (
    "fct_transactions",
    "fct_settlements",
    "mart_settlement_reconciliation",
    "mart_merchant_daily",
    "mart_channel_performance",
)


def run_stamp(number: int):
    """Fixed time of the first or second case sync."""
    return F.timestamp_seconds(F.lit(fixtures.INGESTED + number * fixtures.DAY))


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str, faulty: bool) -> None:
        self.spark = use_utc(spark)
        self.sf_dir = sf_dir
        self.faulty = faulty
        self._built: dict[str, object] = {}

    def _once(self, name: str, build: Callable[[], object]):
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    # --- raw, lazy

    def source(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def charges(self) -> DataFrame:
        return fixtures.charges(self.source("orders"), self.faulty)

    def tasks(self) -> int:
        """Tasks that events of both kinds are made in, and buckets that they are kept in."""
        return self._once(
            "tasks", lambda: fixtures.tasks_for(self.source("orders"), self.source("lineitem"))
        )

    def raw_transactions(self) -> DataFrame:
        orders = self.source("orders")
        return fixtures.transaction_events(
            fixtures.charges_by_ref(orders, self.tasks(), self.faulty), self.faulty
        )

    def raw_settlements(self) -> DataFrame:
        orders, lineitem = self.source("orders"), self.source("lineitem")
        return fixtures.settlement_events(orders, lineitem, self.tasks(), self.faulty)

    def messages(self) -> DataFrame:
        return fixtures.messages(self.source("events"))

    # --- staged and marts, written once

    def staged_rows(self, dataset: str, rows: DataFrame) -> DataFrame:
        root = scratch(self.spark, "staged")
        write_staged(rows, root, dataset)
        return read_staged(self.spark, root, dataset)

    def _kept_by_ref(self, dataset: str, rows: DataFrame) -> DataFrame:
        schema, _ = STAGED[dataset]
        rows = rows.select(*schema.names)
        return materialize_by(rows, f"staged_{dataset}", "transaction_ref", self.tasks())

    def stg_transactions(self) -> DataFrame:
        return self._once(
            "stg_transactions",
            lambda: staging.stg_transactions(
                self._kept_by_ref("transactions", staging.stage_transactions(self.raw_transactions()))
            ),
        )

    def stg_settlements(self) -> DataFrame:
        return self._once(
            "stg_settlements",
            lambda: staging.stg_settlements(
                self._kept_by_ref("settlements", staging.stage_settlements(self.raw_settlements()))
            ),
        )

    def by_reference(self) -> ByReference:
        return self._once(
            "by_reference",
            lambda: write_by_reference(
                self.stg_transactions(), self.stg_settlements(), scratch(self.spark, "by-reference")
            ),
        )

    def mart(self, name: str) -> DataFrame:
        tx, stl = self.stg_transactions, self.stg_settlements
        builders = {
            "fct_transactions": lambda: marts.fct_transactions(tx()),
            "fct_settlements": lambda: marts.fct_settlements(stl(), tx()),
            "mart_settlement_reconciliation": lambda: reconcile(tx(), stl()),
            "mart_merchant_daily": lambda: marts.mart_merchant_daily(tx()),
            "mart_channel_performance": lambda: marts.mart_channel_performance(tx()),
        }
        if name == "fct_settlements":
            return self._once(
                name, lambda: materialize_by(builders[name](), name, "transaction_ref", self.tasks())
            )
        return self._once(name, lambda: materialize(builders[name](), name, "zstd"))

    @property
    def recon(self) -> DataFrame:
        return self.mart("mart_settlement_reconciliation")

    @property
    def fct_tx(self) -> DataFrame:
        return self.mart("fct_transactions")

    @property
    def fct_stl(self) -> DataFrame:
        return self.mart("fct_settlements")

    @property
    def daily(self) -> DataFrame:
        return self.mart("mart_merchant_daily")

    @property
    def channels(self) -> DataFrame:
        return self.mart("mart_channel_performance")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.mart(name) for name in MARTS}

    # --- cases: first run, analyst actions, second run

    def no_cases(self) -> DataFrame:
        return self.spark.createDataFrame([], nullable(CASE))

    def first_cases(self) -> DataFrame:
        breaks = fixtures.first_breaks(self.recon)
        return self._once(
            "first_cases",
            lambda: materialize(
                sync_cases(self.no_cases(), breaks, run_stamp(1)), "cases", "zstd"
            ),
        )

    def requests(self) -> DataFrame:
        return fixtures.action_log(fixtures.first_breaks(self.recon))

    def applied(self) -> AppliedActions:
        return self._once(
            "applied", lambda: apply_actions(self.first_cases(), self.requests())
        )

    def second_cases(self) -> DataFrame:
        return self._once(
            "second_cases",
            lambda: materialize(
                sync_cases(
                    self.applied().cases, fixtures.second_breaks(self.recon), run_stamp(2)
                ),
                "cases",
                "zstd",
            ),
        )

    def effective(self) -> DataFrame:
        return effective_cases(self.second_cases())

    def queue(self) -> Queue:
        def build() -> Queue:
            queue = Queue(self.spark, scratch(self.spark, "queue"))
            cases = self.effective()
            # several ranges on small tables too, and no larger ones on large tables
            queue.write(cases, ranges=max(4, -(-cases.count() // RANGE_CASES)))
            return queue

        return self._once("queue", build)

    # --- ledger

    def chunks(self) -> DataFrame:
        return fixtures.chunks(self.charges())


_OPEN: dict[tuple[str, str, bool], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str, faulty: bool = False) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir, faulty)
    if key not in _OPEN:
        _OPEN[key] = Workspace(spark, sf_dir, faulty)
    return _OPEN[key]
