"""The case queue as a table that pages are read from.

Cases are sorted by the order of the queue over all files, and each range of them has its bounds
and its counts by view and break type kept beside it. A page follows a cursor, the last row of the
page before: the bounds tell which exposures the page can have, that goes to the scan, and
only the row groups of a range or two are read, however far down the page lies. Totals come from the
kept counts. A second copy lies in buckets by case_id, so one case is one small folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.cases import QUEUE_ORDER, case_with_actions, in_view
from tallymark.schemas import BREAK_TYPES, QUEUE_VIEWS
from tallymark.sources.states import States

#: Cases in a range, about.
RANGE_CASES = 100_000

#: Hexadecimal digits of case_id that name a bucket.
BUCKET_DIGITS = 2

Cursor = tuple  # (exposure_kobo, succeeded_date, case_id) of the last row seen

EMPTY = {"pages": None, "cases": None, "ranges": []}


def _order() -> list[Column]:
    exposure, day, key = QUEUE_ORDER
    return [F.desc(exposure), F.asc(day), F.asc(key)]


def _counter(view: str, break_type: str) -> str:
    return f"{view}/{break_type}"


def after_cursor(cursor: Cursor) -> Column:
    """Rows behind the cursor. The first condition alone can be pushed to a scan."""
    exposure, day, key = (F.col(c) for c in QUEUE_ORDER)
    most, last_day, last_key = (F.lit(value) for value in cursor)
    tied = (day > last_day) | ((day == last_day) & (key > last_key))
    return (exposure <= most) & ((exposure < most) | tied)


@dataclass(frozen=True)
class Queue:
    spark: SparkSession
    root: str

    @property
    def states(self) -> States:
        return States(self.spark, self.root, EMPTY, lambda s: [f for f in (s["pages"], s["cases"]) if f])

    def write(self, effective: DataFrame, ranges: int | None = None) -> None:
        """Replace the queue by the cases of `effective_cases`."""
        if ranges is None:
            ranges = max(1, -(-effective.count() // RANGE_CASES))
        version = uuid.uuid4().hex
        pages, cases = f"pages/v={version}", f"cases/v={version}"
        ordered = effective.repartitionByRange(ranges, *_order()).sortWithinPartitions(*_order())
        ordered.withColumn("range", F.spark_partition_id()).write.parquet(f"{self.root}/{pages}")
        written = self._read(pages)
        bucket = F.substring("case_id", 1, BUCKET_DIGITS)
        (
            written.drop("range")
            .withColumn("bucket", bucket)
            .repartition("bucket")
            .write.partitionBy("bucket")
            .parquet(f"{self.root}/{cases}")
        )
        counts = {
            _counter(view, kind): F.count_if(in_view(view) & (F.col("break_type") == kind))
            for view in QUEUE_VIEWS
            for kind in BREAK_TYPES
        }
        rows = written.groupBy("range").agg(
            F.min(QUEUE_ORDER[0]).alias("least"),
            F.max(QUEUE_ORDER[0]).alias("most"),
            *[count.alias(name) for name, count in counts.items()],
        )
        kept = [r.asDict() for r in rows.orderBy("range").collect()]  # one row a range
        state = {"pages": pages, "cases": cases, "ranges": kept}
        self.states.change(lambda _: (state, None), keep_drafts=True)

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{folder}")

    def _live(self) -> dict:
        _, state = self.states.live()
        if state["pages"] is None:
            raise FileNotFoundError(f"no queue has been written under {self.root}")
        return state

    def total(self, view: str = "active", break_type: str | None = None) -> int:
        """Cases of a view, from the kept counts."""
        return sum(_count(kept, view, break_type) for kept in self._live()["ranges"])

    def page(
        self,
        view: str = "active",
        break_type: str | None = None,
        limit: int = 50,
        after: Cursor | None = None,
    ) -> DataFrame:
        """The rows of the queue that follow the cursor, or its first ones."""
        state = self._live()
        rows = self._read(state["pages"]).drop("range").where(in_view(view))
        if break_type is not None:
            rows = rows.where(F.col("break_type") == break_type)
        if after is not None:
            rows = rows.where(after_cursor(after))
        least = _least_exposure(state["ranges"], view, break_type, limit, after)
        if least is not None:
            rows = rows.where(F.col(QUEUE_ORDER[0]) >= least)
        return rows.orderBy(*_order()).limit(limit)

    def case(self, case_id: str, actions: DataFrame) -> DataFrame:
        """One case with its actions: reads the bucket of its id."""
        cases = self._read(self._live()["cases"])
        own = cases.where(F.col("bucket") == case_id[:BUCKET_DIGITS]).drop("bucket")
        return case_with_actions(own, actions, F.lit(case_id))


def _count(kept: dict, view: str, break_type: str | None) -> int:
    kinds = BREAK_TYPES if break_type is None else (break_type,)
    return sum(kept.get(_counter(view, kind), 0) for kind in kinds)


def _least_exposure(ranges: list[dict], view: str, break_type: str | None, limit: int, after: Cursor | None):
    """An exposure above which the page surely lies: that of the range with which enough rows have
    been counted that stand wholly behind the cursor. None where the queue ends before."""
    enough = 0
    for kept in ranges:
        if after is None or kept["most"] < after[0]:
            enough += _count(kept, view, break_type)
        if enough >= limit:
            return kept["least"]
    return None
