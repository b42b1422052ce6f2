"""The ledger of committed publish chunks: what a retry may skip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.schemas import PUBLISH_LEDGER

KEY = ["run_key", "chunk_start"]


def pending_chunks(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    """Chunks of the run that are not committed yet."""
    return chunks.join(ledger.select(*KEY), KEY, "anti")


def record_chunks(ledger: DataFrame, committed: DataFrame) -> DataFrame:
    """The ledger with the new chunks. Recording a chunk twice changes nothing: the
    entry already in the ledger wins, and of equal new ones the earliest."""
    rest = [c for c in PUBLISH_LEDGER.names if c not in KEY and c != "committed_at"]
    both = ledger.withColumn("_new", F.lit(0)).unionByName(committed.withColumn("_new", F.lit(1)))
    return (
        both.groupBy(*KEY)
        .agg(F.min(F.struct("_new", "committed_at", *rest)).alias("_first"))
        .select(*KEY, "_first.*")
        .select(*PUBLISH_LEDGER.names)
    )
