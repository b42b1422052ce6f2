"""Staged charges and settlement lines kept together by transaction_ref.

Both tables are written once as bucketed tables: equal references lie in the bucket of equal
number, sorted, one file a bucket. Whatever joins or groups them by reference afterwards
reads bucket against bucket and moves no row: the mart, the facts and the checks share the one
exchange of the write.

A bucket that is read as it stands cannot be split at run time, so skew is settled at the
write. A reference that owns more than `hot_lines` settlement lines gets several slots: its lines
are dealt over them by settlement_id, and its charge is repeated once in each. Slot 0 of a charge
is the charge itself. References with slots are few (MOST_HOT at most: the limit of lines grows
with the table), so they are broadcast.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.sources.files import create_file, read_file
from tallymark.sources.tables import materialize

KEY = ("transaction_ref", "ref_slot")
TABLES = ("charges", "lines")
LAYOUT = "_LAYOUT"

#: Lines in a bucket, about.
BUCKET_LINES = 2_000_000

#: Lines of one reference that stay in one bucket.
HOT_LINES = 500_000

#: References that may have slots.
MOST_HOT = 1_000


@dataclass(frozen=True)
class ByReference:
    """charges: staged transactions with ref_slot and ref_slots, a row for each slot. lines:
    staged settlements with ref_slot. as_of: day of the last ingestion of a charge."""

    charges: DataFrame
    lines: DataFrame
    as_of: date | None
    buckets: int

    def one_each(self) -> DataFrame:
        """Charges without their repetitions."""
        return self.charges.where(F.col("ref_slot") == 0)


def _hot(lines: DataFrame, total: int, hot_lines: int) -> DataFrame:
    """(hot_ref, ref_slots) of the references that own more lines than a bucket should take."""
    most = max(hot_lines, -(-total // MOST_HOT))
    counted = lines.where(F.col("transaction_ref").isNotNull()).groupBy("transaction_ref").count()
    hot = counted.where(F.col("count") > most)
    return hot.select(
        F.col("transaction_ref").alias("hot_ref"), F.ceil(F.col("count") / most).cast("int").alias("ref_slots")
    )


def _slotted(rows: DataFrame, hot: DataFrame) -> DataFrame:
    joined = rows.join(F.broadcast(hot), F.col("transaction_ref") == F.col("hot_ref"), "left").drop("hot_ref")
    return joined.withColumn("ref_slots", F.coalesce("ref_slots", F.lit(1)))


def _name(path: str, table: str) -> str:
    return f"by_reference_{table}_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"


def write_by_reference(
    stg_tx: DataFrame,
    stg_stl: DataFrame,
    path: str,
    buckets: int | None = None,
    hot_lines: int = HOT_LINES,
) -> ByReference:
    """Lay both staged tables out under `path`, which must be new."""
    spark = stg_tx.sparkSession
    total = stg_stl.count()
    if buckets is None:
        buckets = max(spark.sparkContext.defaultParallelism, -(-total // BUCKET_LINES))
    hot = materialize(_hot(stg_stl, total, hot_lines), "hot-references")
    dealt = F.pmod(F.xxhash64("settlement_id"), F.col("ref_slots")).cast("int")
    # no null matches anything, so lines without a reference may lie anywhere
    anywhere = F.pmod(F.xxhash64("settlement_id"), F.lit(buckets)).cast("int")
    slot = F.when(F.col("transaction_ref").isNull(), anywhere).otherwise(dealt)
    lines = _slotted(stg_stl, hot).withColumn("ref_slot", slot).drop("ref_slots")
    every = F.explode(F.sequence(F.lit(0), F.col("ref_slots") - 1))
    charges = _slotted(stg_tx, hot).withColumn("ref_slot", every)

    for table, rows in zip(TABLES, (charges, lines), strict=True):
        (
            rows.repartition(buckets, *KEY)
            .write.format("parquet")
            .bucketBy(buckets, *KEY)
            .sortBy(*KEY)
            .option("path", f"{path}/{table}")
            .saveAsTable(_name(path, table))
        )
    last = spark.table(_name(path, "charges")).agg(F.max("ingested_at")).first()[0]
    layout = {
        "buckets": buckets,
        "as_of": None if last is None else last.date().isoformat(),
        "schemas": {table: spark.table(_name(path, table)).schema.json() for table in TABLES},
    }
    create_file(spark, f"{path}/{LAYOUT}", json.dumps(layout))
    return open_by_reference(spark, path)


def open_by_reference(spark: SparkSession, path: str) -> ByReference:
    """The layout under `path`, also in a session that did not write it."""
    text = read_file(spark, f"{path}/{LAYOUT}")
    if text is None:
        raise FileNotFoundError(f"no complete layout by reference under {path}")
    layout = json.loads(text)
    found = {}
    for table in TABLES:
        name = _name(path, table)
        if not spark.catalog.tableExists(name):
            _declare(spark, name, f"{path}/{table}", layout["schemas"][table], layout["buckets"])
        found[table] = spark.table(name)
    as_of = None if layout["as_of"] is None else date.fromisoformat(layout["as_of"])
    return ByReference(found["charges"], found["lines"], as_of, layout["buckets"])


def _declare(spark: SparkSession, name: str, path: str, schema: str, buckets: int) -> None:
    fields = StructType.fromJson(json.loads(schema)).fields
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    keys = ", ".join(KEY)
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by ({keys}) sorted by ({keys})"
        f" into {buckets} buckets location '{path}'"
    )


def drop_by_reference(spark: SparkSession, path: str) -> None:
    """Forget the tables; the files stay."""
    for table in TABLES:
        spark.sql(f"drop table if exists {_name(path, table)}")
