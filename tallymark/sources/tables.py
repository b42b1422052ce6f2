"""Raw, staged and mart tables on a file store, read and written in place.

Reads declare their schema: no inference job, no footer merge, and a file written
before a column existed gives nulls for it. Writes that partition by a date use a
rebalance hint, which lets adaptive execution split a day that holds most of the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.schemas import (
    SETTLEMENT_EVENT,
    STAGED_SETTLEMENT,
    STAGED_TRANSACTION,
    TRANSACTION_EVENT,
    nullable,
)
from tallymark.session import scratch

DATASETS = {"transactions": TRANSACTION_EVENT, "settlements": SETTLEMENT_EVENT}
STAGED = {
    "transactions": (STAGED_TRANSACTION, "event_date"),
    "settlements": (STAGED_SETTLEMENT, "settlement_date"),
}


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def count_files(spark: SparkSession, path: str) -> int:
    """Data files under a folder; marker and hidden files do not count."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True)
    count = 0
    while found.hasNext():
        count += found.next().getPath().getName()[0] not in "._"
    return count


COMMITTED = "dataset string, batch string"


def _commits(spark: SparkSession, root: str) -> DataFrame:
    """(dataset, batch) of every batch whose commit record was written."""
    if not path_exists(spark, f"{root}/commits"):
        return spark.createDataFrame([], COMMITTED)
    return spark.read.schema(COMMITTED).json(f"{root}/commits")


def committed_rows(spark: SparkSession, root: str, dataset: str, schema: StructType) -> DataFrame:
    """Rows of committed batches only: a half-written batch of a drain that is still going, or
    died, stays out. The join prunes batch folders before any file is read."""
    raw = spark.read.schema(
        StructType(list(nullable(schema).fields)).add("batch", "string").add("ingest_date", "date")
    ).parquet(f"{root}/{dataset}")
    done = _commits(spark, root).where(F.col("dataset") == dataset).select("batch").distinct()
    return raw.join(done, "batch", "semi").select(*schema.names)


def read_raw(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Every committed delivery of a dataset, over all drains."""
    path = f"{root}/{dataset}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no raw data under {path}; run the ingest first")
    return committed_rows(spark, root, dataset, DATASETS[dataset])


def write_staged(staged: DataFrame, root: str, dataset: str) -> str:
    schema, day = STAGED[dataset]
    path = f"{root}/{dataset}"
    (
        staged.select(*schema.names)
        .hint("rebalance", day)
        .write.mode("overwrite")
        .partitionBy(day)
        .parquet(path)
    )
    return path


def read_staged(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    schema, _ = STAGED[dataset]
    return spark.read.schema(schema).parquet(f"{root}/{dataset}").select(*schema.names)


def write_table(df: DataFrame, path: str) -> str:
    """A mart as plain Parquet, replaced as a whole."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(nullable(schema)).json(path)


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared work folder and read back: cuts the lineage, and unlike a
    cache or a local checkpoint it survives the loss of any executor."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """`materialize` in buckets of one column, so that later joins and groupings on it move no row.

    For rows that already lie dealt by the key over `buckets` tasks: these write one file each.
    Rows that lie otherwise are not moved; each task writes a file for every bucket it has. A
    bucket is read by one task, so no key may own much more than a task should take.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (
        df.write.format("parquet")
        .option("compression", "zstd")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", scratch(spark, name))
        .saveAsTable(table)
    )
    return spark.table(table)
