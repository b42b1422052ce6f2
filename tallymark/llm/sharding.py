"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records hash into SLOTS virtual slots, for good. A map says which shard holds which slot.
Rebalancing aggregates the bytes of each slot and edits the map: slots of a shard stay while
they fit under the mean, the others go, largest first, to the shard with the least bytes.
Every version is kept as a table. Slots are few by definition, so maps and slot sums are
tables of a fixed size whatever the input's.

All of it is DataFrame expressions; the greedy placement is a fold over the slots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.session import scratch
from tallymark.sources.files import list_names
from tallymark.sources.tables import materialize

SLOTS = 4096

#: Bytes a row costs besides its text.
ROW_BYTES = 16

#: Parts of a slot that number their rows apart from each other.
PARTS = 16

#: A slot with so many times the mean rows (and at least HOT_ROWS) holds many equal rows: they
#: are dealt out by their row number instead.
HOT_TIMES = 16
HOT_ROWS = 1000


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot and row (a number of no meaning), as a written table."""
    raw = F.col("text").cast("binary")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
    )
    rows = rows.withColumn("home", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "records")
    counts = rows.groupBy("home").agg(F.count("*").alias("n"))
    mean = F.sum("n").over(Window.partitionBy(F.lit(1))) / slots
    hot = counts.withColumn("hot", F.col("n") > F.greatest(mean * HOT_TIMES, F.lit(float(HOT_ROWS))))
    hot = F.broadcast(hot.filter("hot").select("home", "hot"))  # at most `slots` rows
    dealt = F.pmod(F.xxhash64("row"), F.lit(slots))
    rows = rows.join(hot, "home", "left")
    return rows.withColumn("vslot", F.when(F.col("hot"), dealt).otherwise(F.col("home"))).drop(
        "home", "hot"
    )


def slot_sums(rows: DataFrame) -> DataFrame:
    """(vslot, bytes): at most one row per slot."""
    return rows.groupBy("vslot").agg(F.sum("size").alias("bytes"))


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: slots dealt out evenly, known before any data."""
    return spark.range(slots).select(
        F.lit(0).alias("version"),
        F.col("id").alias("vslot"),
        (F.col("id") % shards).cast("int").alias("shard"),
    )


def _with_bytes(slot_map: DataFrame, sums: DataFrame) -> DataFrame:
    joined = slot_map.join(F.broadcast(sums), "vslot", "left")
    return joined.withColumn("bytes", F.coalesce("bytes", F.lit(0)))


def _kept(held: DataFrame, shards: int) -> DataFrame:
    """Marks the slots that stay: those that fit under the mean, smallest first."""
    mean = F.sum("bytes").over(Window.partitionBy(F.lit(1))) / shards
    filled = F.sum("bytes").over(Window.partitionBy("shard").orderBy("bytes", "vslot"))
    return held.withColumn("stays", filled <= mean)


def rebalance(slot_map: DataFrame, sums: DataFrame, shards: int) -> DataFrame:
    """The next version: (version, vslot, shard) with near equal bytes for each shard."""
    marked = _kept(_with_bytes(slot_map, sums), shards)
    loads = marked.groupBy("shard").agg(F.sum(F.when(F.col("stays"), F.col("bytes"))).alias("load"))
    every = slot_map.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    loads = every.join(loads, "shard", "left").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("shard", F.coalesce("load", F.lit(0)).alias("load")))),
            lambda s: s["load"].cast("long"),
        ).alias("loads")
    )
    moving = marked.agg(
        F.array_sort(
            F.collect_list(
                F.when(
                    ~F.col("stays"),
                    F.struct((-F.col("bytes")).alias("order"), "vslot", "bytes"),
                )
            )
        ).alias("moving"),
        F.max("version").alias("version"),
    )
    start = F.struct(
        F.col("loads").alias("loads"),
        F.expr("cast(array() as array<struct<vslot: bigint, shard: int>>)").alias("placed"),
    )

    def put(state, slot):
        least = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        return F.struct(
            F.transform(
                state["loads"],
                lambda load, at: F.when(at == least, load + slot["bytes"]).otherwise(load),
            ).alias("loads"),
            F.concat(
                state["placed"],
                F.array(F.struct(slot["vslot"].alias("vslot"), least.alias("shard"))),
            ).alias("placed"),
        )

    folded = moving.join(loads).select(F.aggregate("moving", start, put, lambda s: s["placed"]).alias("p"))
    moved = folded.select(F.explode("p").alias("m")).select(
        F.col("m.vslot").alias("vslot"), F.col("m.shard").alias("to")
    )
    return marked.join(F.broadcast(moved), "vslot", "left").select(
        (F.col("version") + 1).alias("version"), "vslot", F.coalesce("to", "shard").alias("shard")
    )


def grow(slot_map: DataFrame, sums: DataFrame, shards: int) -> DataFrame:
    """The next version with one shard more (`shards` is the new number): what does not fit
    under the new mean moves into the new shard, nothing moves between the old ones."""
    marked = _kept(_with_bytes(slot_map, sums), shards)
    return marked.select(
        (F.col("version") + 1).alias("version"),
        "vslot",
        F.when(F.col("stays"), F.col("shard")).otherwise(F.lit(shards - 1)).alias("shard"),
    )


def save_version(slot_map: DataFrame, folder: str) -> DataFrame:
    """Adds a version to the stored map and reads it back."""
    version = slot_map.agg(F.max("version")).first()[0]
    path = f"{folder}/version={version}"
    slot_map.drop("version").coalesce(1).write.parquet(path)
    spark = slot_map.sparkSession
    stored = spark.read.schema(slot_map.drop("version").schema).parquet(path)
    return stored.withColumn("version", F.lit(version))


def latest(spark: SparkSession, folder: str) -> DataFrame | None:
    """The newest stored version of the map, or None where none is stored."""
    names = [name for name in list_names(spark, folder) if name.startswith("version=")]
    if not names:
        return None
    newest = max(int(name.partition("=")[2]) for name in names)
    stored = spark.read.schema("vslot long, shard int").parquet(f"{folder}/version={newest}")
    return stored.withColumn("version", F.lit(newest))


def assign(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Rows with shard and slot, their place in the shard, counted from 0 without a gap.

    Rows are numbered inside small parts of their virtual slot; the parts' counts, at most
    PARTS for each slot, are summed up along the shard. So no shard is sorted in one task.
    """
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(PARTS)))
    slots = F.broadcast(slot_map.select("vslot", "shard"))
    parts = rows.groupBy("vslot", "part").agg(F.count("*").alias("n")).join(slots, "vslot")
    ahead = Window.partitionBy("shard").orderBy("vslot", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "vslot", "part", "shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("vslot", "part").orderBy("doc_id", "text_crc32", "row")
    numbered = rows.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(parts, ["vslot", "part"]).withColumn("slot", F.col("first") + F.col("place"))


def shard(docs: DataFrame, shards: int = 40, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot.

    The law is `bytes`: sizes of shards are near equal (they differ by about the size of a
    small slot, or of one document if that is larger). grown_shard is null under this law.
    folder holds the versions of the map: the newest one is edited, so that a later and larger table
    moves only the slots that no longer fit, and the edit is stored as the next. Without a folder, or
    with an empty one, the map starts anew. Equal texts under one id share a slot of the map.
    A null text has no bytes and the checksum 0; a null doc_id hashes as such. Repeated rows
    are placed one by one. Columns other than doc_id and text are not read; an empty table
    gives no rows, and all shards are empty.
    """
    spark = docs.sparkSession
    rows = records(docs, slots)
    folder = folder or scratch(spark, "slot-map")
    current = latest(spark, folder)
    if current is None:
        current = save_version(first_map(spark, shards, slots), folder)
    sums = materialize(slot_sums(rows), "slot-sums")
    current = save_version(rebalance(current, sums, shards), folder)
    return assign(rows, current).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )
