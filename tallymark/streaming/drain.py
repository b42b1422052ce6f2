"""Draining message topics into the raw layer.

A drain reads what is there and stops (`availableNow`). Each micro-batch writes its good
rows and its quarantine under one batch folder per dataset and then a commit record. A
batch that is retried after a failure overwrites its own folders, so a crash at any point
neither loses nor doubles a row; offsets advance only after all writes are done. Several
topics in one stream share one batch and so commit together.

    <out>/<dataset>/batch=<tag>-<id>/ingest_date=<day>/*.parquet
    <out>/quarantine/<dataset>/batch=<tag>-<id>/ingest_date=<day>/*.parquet
    <out>/commits/batch=<tag>-<id>/*.json
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.operators.coerce import accepted, coerce, quarantined, require_rows
from tallymark.sources.tables import count_files, path_exists

COMMIT = (
    "dataset string, topic string, consumed bigint, written bigint, malformed bigint,"
    " files bigint, quarantine_files bigint, ingested_at string"
)


_COUNTS = ("consumed", "written", "malformed", "files", "quarantine_files")


@dataclass(frozen=True)
class Dataset:
    name: str
    topic: str
    schema: StructType


def checkpoint_tag(checkpoint: str) -> str:
    """A new checkpoint is a new reader: its batches must not overwrite older ones."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def _write(df: DataFrame, path: str) -> tuple[int, int]:
    """Replace one batch folder and return its rows, counted while writing, and its files."""
    counted = Observation()
    (
        df.withColumn("ingest_date", F.to_date("ingested_at"))
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("ingest_date")
        .parquet(path)
    )
    return counted.get["rows"], count_files(df.sparkSession, path)


def write_batch(
    batch: DataFrame, batch_name: str, datasets: list[Dataset], out: str, stamp: datetime
) -> list[dict]:
    """Write one batch of every dataset, commit record last."""
    spark = batch.sparkSession
    ingested_at = F.lit(stamp.isoformat()).cast("timestamp")
    records = []
    for dataset in datasets:
        # read twice, by the two writes; recomputed from the source if a block is lost
        rows = coerce(batch.where(F.col("topic") == dataset.topic), dataset.schema).persist(
            StorageLevel.MEMORY_AND_DISK
        )
        try:
            folder = f"batch={batch_name}"
            good = accepted(rows, dataset.schema, ingested_at)
            written, files = _write(good, f"{out}/{dataset.name}/{folder}")
            bad = quarantined(rows, ingested_at)
            malformed, bad_files = _write(bad, f"{out}/quarantine/{dataset.name}/{folder}")
        finally:
            rows.unpersist()
        records.append(
            {
                "dataset": dataset.name,
                "topic": dataset.topic,
                "consumed": written + malformed,
                "written": written,
                "malformed": malformed,
                "files": files,
                "quarantine_files": bad_files,
                "ingested_at": stamp.isoformat(),
            }
        )
    commit = spark.createDataFrame(records, COMMIT).coalesce(1)
    commit.write.mode("overwrite").json(f"{out}/commits/batch={batch_name}")
    return records


def drain(
    messages: DataFrame,
    datasets: list[Dataset],
    out: str,
    checkpoint: str,
    stamp: datetime | None = None,
) -> dict[str, dict[str, int]]:
    """Drain the stream and return counts per dataset for this run."""
    stamp = stamp or datetime.now(UTC)
    tag = checkpoint_tag(checkpoint)
    stats = {d.name: dict.fromkeys((*_COUNTS, "batches"), 0) for d in datasets}

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        for record in write_batch(batch, f"{tag}-{batch_id:08d}", datasets, out, stamp):
            counts = stats[record["dataset"]]
            for key in _COUNTS:
                counts[key] += record[key]
            counts["batches"] += 1

    query = (
        messages.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stats


def ingest(
    streams: list[tuple[DataFrame, list[Dataset], str]], out: str, stamp: datetime | None = None
) -> dict[str, dict[str, int]]:
    """Drain every stream; a run that wrote nothing at all fails."""
    stats: dict[str, dict[str, int]] = {}
    for messages, datasets, checkpoint in streams:
        stats.update(drain(messages, datasets, out, checkpoint, stamp))
    require_rows({name: counts["written"] for name, counts in stats.items()})
    return stats


def commits(spark: SparkSession, out: str) -> DataFrame:
    """One row per dataset and committed batch."""
    if not path_exists(spark, f"{out}/commits"):
        return spark.createDataFrame([], f"{COMMIT}, batch string")
    return spark.read.schema(f"{COMMIT}, batch string").json(f"{out}/commits")
