"""Continuous forms of dedupe and latest status.

Both keep what they know as runs: folders of rows, written once. A micro-batch adds a run and
rewrites none; when FOLD runs of one level have come together they are folded into one of the
next, so a row is rewritten as often as the history has levels, and what a batch costs follows the
batch. Which runs are live stands in numbered states (`sources.states`): a batch adds its run to
the state it has read, or starts again from a newer one, so two streams on one folder, or a
replay with a new checkpoint, lose and double nothing. No event is too late.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallymark.functions import status_rank
from tallymark.operators.staging import TRANSACTION_KEY
from tallymark.schemas import TRANSACTION_EVENT, nullable
from tallymark.sources.files import create_file, delete_path, read_file
from tallymark.sources.states import States
from tallymark.sources.tables import materialize

#: Runs of one level that are folded into one of the next.
FOLD = 8

#: Keys in a bucket of a key run, about. A run's directory is as deep as its keys ask for.
BUCKET_KEYS = 50_000

#: Digits of a key's hash that buckets may go by: 4,096 in a run at most.
DEEPEST = 3

#: A batch of up to so many keys asks the Bloom filters of the key files for each of them.
POINT_KEYS = 10

#: Event folders that the state names itself; more are named by a list of their own.
LISTED = 256

_ORDER = ("updated_at", "status_rank", "event_id")
_REST = tuple(
    c for c in TRANSACTION_EVENT.names if c not in (*_ORDER, "transaction_ref", "ingested_at")
)
_SNAPSHOT = StructType([*nullable(TRANSACTION_EVENT).fields]).add("successful_at", "timestamp")
_KEYS = (
    StructType()
    .add("key_hash", "string")
    .add("transaction_ref", "string")
    .add("event_id", "string")
    .add("bucket", "string")
)


def _run(events: DataFrame, on_batch, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = events.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


# --- runs


def _fold(states: States, merge: Callable[[list[dict], int], dict]) -> None:
    """Fold runs of a level while there are FOLD of them. `merge` writes the folded run. A run
    that another writer has folded meanwhile is left alone: the fold starts again."""
    while True:
        _, state = states.live()
        levels: dict[int, list[dict]] = {}
        for run in state["runs"]:
            levels.setdefault(run["level"], []).append(run)
        full = [level for level in sorted(levels) if len(levels[level]) >= FOLD]
        if not full:
            return
        old = levels[full[0]]
        new = merge(old, full[0] + 1)

        def swap(now: dict, old=old, new=new) -> tuple[dict, bool]:
            if any(run not in now["runs"] for run in old):
                return now, False
            rest = [run for run in now["runs"] if run not in old]
            return {**now, "runs": [*rest, new]}, True

        if not states.change(swap, keep_drafts=True):
            delete_path(states.spark, f"{states.root}/{new['folder']}")


# --- first deliveries


def _first_states(spark: SparkSession, out: str) -> States:
    """runs: key runs with level, folder, depth, rows. events, lists: folders of kept events and
    files that list further ones; neither is ever removed."""
    empty = {"runs": [], "events": [], "lists": []}
    return States(spark, out, empty, lambda state: [run["folder"] for run in state["runs"]])


def _hashed(rows: DataFrame) -> DataFrame:
    """Keys with the hash that key runs go by: uniform, so its digits make even buckets."""
    parts = [F.coalesce(F.concat(F.lit("k"), F.col(k).cast("string")), F.lit("n")) for k in TRANSACTION_KEY]
    return rows.withColumn("key_hash", F.md5(F.concat_ws("\u0000", *parts).cast("binary")))


def _depth(rows: int) -> int:
    depth = 0
    while depth < DEEPEST and rows > BUCKET_KEYS * 16**depth:
        depth += 1
    return depth


def _write_keys(keys: DataFrame, out: str, level: int, rows: int) -> dict:
    """A key run: nothing but keys, in buckets by the leading digits of their hash, sorted, with
    a Bloom filter on the hash in each row group."""
    depth, folder = _depth(rows), f"keys/v={uuid.uuid4().hex}"
    bucket = F.concat(F.lit("b"), F.substring("key_hash", 1, depth))
    (
        keys.select("key_hash", *TRANSACTION_KEY, bucket.alias("bucket"))
        .repartition("bucket")
        .sortWithinPartitions("bucket", "key_hash")
        .write.partitionBy("bucket")
        .option("parquet.bloom.filter.enabled#key_hash", "true")
        .option("parquet.bloom.filter.expected.ndv#key_hash", str(BUCKET_KEYS))
        .parquet(f"{out}/{folder}")
    )
    return {"level": level, "folder": folder, "depth": depth, "rows": rows}


def _read_keys(spark: SparkSession, out: str, run: dict) -> DataFrame:
    return spark.read.schema(_KEYS).parquet(f"{out}/{run['folder']}")


def known_keys(spark: SparkSession, out: str, runs: list[dict], hashes: DataFrame) -> DataFrame | None:
    """Of the runs, the keys in the buckets that `hashes` (key_hash) fall into. At most 16 **
    DEEPEST names of buckets are collected, and hashes only where there are up to POINT_KEYS."""
    few = [r[0] for r in hashes.select("key_hash").limit(POINT_KEYS + 1).collect()]
    found = None
    prefixes: dict[int, list[str]] = {}
    for run in runs:
        depth = run["depth"]
        if depth not in prefixes:
            digits = F.concat(F.lit("b"), F.substring("key_hash", 1, depth))
            prefixes[depth] = [r[0] for r in hashes.select(digits).distinct().collect()]
        keys = _read_keys(spark, out, run).where(F.col("bucket").isin(prefixes[depth]))
        if len(few) <= POINT_KEYS:
            keys = keys.where(F.col("key_hash").isin(few))
        keys = keys.select(*TRANSACTION_KEY)
        found = keys if found is None else found.unionByName(keys)
    return found


def keep_first_deliveries(batch: DataFrame, batch_name: str, out: str) -> None:
    """Append the events of a batch whose key no other batch has kept.

    Of several deliveries in the batch the earliest stays. Key runs are read in the buckets of
    the batch's keys only, events never. A batch that is retried after its commit finds its own
    keys and adds nothing; one that died before it left nothing that counts.
    """
    spark = batch.sparkSession
    states = _first_states(spark, out)
    rest = [c for c in TRANSACTION_EVENT.names if c not in TRANSACTION_KEY]
    order = ["ingested_at", *[c for c in rest if c != "ingested_at"]]
    first = batch.groupBy(*TRANSACTION_KEY).agg(F.min(F.struct(*order)).alias("first"))
    first = _hashed(first.select(*TRANSACTION_KEY, "first.*"))
    first = materialize(first, "first-deliveries")

    def build(state: dict) -> tuple[dict, None]:
        fresh = first
        known = known_keys(spark, out, state["runs"], first)
        if known is not None:
            same = [first[k].eqNullSafe(known[k]) for k in TRANSACTION_KEY]
            fresh = first.join(known, same, "left_anti")
        folder = f"events/b-{batch_name}-{uuid.uuid4().hex[:8]}"
        fresh.write.parquet(f"{out}/{folder}")
        kept = spark.read.schema(first.schema).parquet(f"{out}/{folder}")
        rows = kept.count()
        if not rows:
            delete_path(spark, f"{out}/{folder}")
            return state, None
        run = _write_keys(kept, out, 0, rows)
        events, lists = [*state["events"], folder], state["lists"]
        if len(events) > LISTED:
            listed = f"lists/{uuid.uuid4().hex}.json"
            create_file(spark, f"{out}/{listed}", json.dumps(events))
            events, lists = [], [*lists, listed]
        return {"runs": [*state["runs"], run], "events": events, "lists": lists}, None

    states.change(build)

    def merge(runs: list[dict], level: int) -> dict:
        keys = _read_keys(spark, out, runs[0])
        for run in runs[1:]:
            keys = keys.unionByName(_read_keys(spark, out, run))
        return _write_keys(keys, out, level, sum(run["rows"] for run in runs))

    _fold(states, merge)


def start_dedupe(
    events: DataFrame, out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Keep one delivery of every event, however late it or its redeliveries come."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        keep_first_deliveries(batch, f"{batch_id:08d}", out)

    return _run(events, on_batch, checkpoint, available_now)


def deduped(spark: SparkSession, out: str) -> DataFrame:
    """The kept events."""
    _, state = _first_states(spark, out).live()
    folders = list(state["events"])
    for listed in state["lists"]:
        folders += json.loads(read_file(spark, f"{out}/{listed}"))
    schema = nullable(TRANSACTION_EVENT)
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{out}/{folder}" for folder in folders])
    return rows.select(*TRANSACTION_EVENT.names)


# --- latest status


def _latest(rows: DataFrame) -> DataFrame:
    """One row per transaction: its last event by event order and its last success.

    max is moved neither by a second copy nor by an older event, so merging a batch twice, or
    in another order, gives the same rows. Of equal events the earliest arrival wins.
    """
    arrival = (-F.unix_micros("ingested_at")).alias("_arrival")
    ranked = rows.withColumn("status_rank", status_rank(F.col("status")))
    latest = F.max(F.struct(*_ORDER, arrival, *_REST)).alias("last")
    grouped = ranked.groupBy("transaction_ref").agg(
        latest, F.max("successful_at").alias("successful_at")
    )
    arrived = F.timestamp_micros(-F.col("_arrival")).alias("ingested_at")
    names = [arrived if c == "ingested_at" else F.col(c) for c in TRANSACTION_EVENT.names]
    return grouped.select("transaction_ref", "last.*", "successful_at").select(*names, "successful_at")


def _latest_states(spark: SparkSession, out: str) -> States:
    return States(spark, out, {"runs": []}, lambda state: [run["folder"] for run in state["runs"]])


def _read_runs(spark: SparkSession, out: str, runs: list[dict]) -> DataFrame:
    return spark.read.schema(_SNAPSHOT).parquet(*[f"{out}/{run['folder']}" for run in runs])


def _write_run(rows: DataFrame, out: str, level: int) -> dict:
    folder = f"latest/v={uuid.uuid4().hex}"
    rows.write.parquet(f"{out}/{folder}")
    return {"level": level, "folder": folder}


def merge_latest(batch: DataFrame, out: str) -> None:
    """Add the winners of a batch as a run; what the snapshot held before is not read. Merging
    is left to the reader and to the folding of runs."""
    spark = batch.sparkSession
    success = F.when(F.col("status") == "success", F.col("updated_at")).alias("successful_at")
    run = _write_run(_latest(batch.select(*TRANSACTION_EVENT.names, success)), out, 0)
    states = _latest_states(spark, out)
    states.change(lambda state: ({"runs": [*state["runs"], run]}, None), keep_drafts=True)
    _fold(states, lambda runs, level: _write_run(_latest(_read_runs(spark, out, runs)), out, level))


def start_latest_status(
    events: DataFrame, out: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Keep the snapshot of latest statuses current. Merging is idempotent: a retried batch or
    a replay changes nothing."""
    return _run(events, lambda batch, _: merge_latest(batch, out), checkpoint, available_now)


def live_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """Current row per transaction: the live runs, merged."""
    _, state = _latest_states(spark, out).live()
    if not state["runs"]:
        return spark.createDataFrame([], _SNAPSHOT)
    return _latest(_read_runs(spark, out, state["runs"]))
