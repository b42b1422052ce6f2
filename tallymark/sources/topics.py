"""Streams of messages: a `value` column (binary) and a `topic` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Messages of one micro-batch at most. A drain goes on until nothing is left, so the limit
#: only sets how much is done between two commits.
MAX_OFFSETS = 50_000_000


def kafka_messages(
    spark: SparkSession,
    bootstrap: str,
    topics: list[str],
    max_offsets_per_trigger: int | None = MAX_OFFSETS,
    **options: str,
) -> DataFrame:
    """Committed messages of the topics from the earliest offset on.

    Needs the Kafka connector on the session's class path. The start offset applies to a
    new checkpoint only, so a new checkpoint replays everything.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("kafka.isolation.level", "read_committed")
        .option("failOnDataLoss", "true")
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select("value", "topic")


def file_messages(
    spark: SparkSession, path: str, topic: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """JSON lines in a folder as messages of one topic."""
    reader = spark.readStream.schema("value string")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.text(path)
    return lines.select(F.col("value").cast("binary").alias("value"), F.lit(topic).alias("topic"))
