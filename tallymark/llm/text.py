"""Words of whole texts as arrays, for tasks that receive Arrow batches.

A word is `[^\\x20\\x09-\\x0D]+`: the ASCII spaces separate, nothing else does. Words are
split and coded by Arrow's kernels, so Python touches each distinct word of a batch once.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of one Arrow batch. One row may be longer.
BATCH_BYTES = "4m"

#: Texts handed to the array code at once. One text may be longer; it then goes alone.
CHUNK_BYTES = 1 << 20

_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the word."""
    with np.errstate(over="ignore"):
        values = values + _STEP
        values = (values ^ (values >> np.uint64(30))) * _MIX_A
        values = (values ^ (values >> np.uint64(27))) * _MIX_B
        return values ^ (values >> np.uint64(31))


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts stay under CHUNK_BYTES; a longer text comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > CHUNK_BYTES:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in order, and for each text the place of its first word
    (one more entry at the end). Null and blank texts have no words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), before[ends].astype(np.int64)


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash for each word."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    hashes = np.fromiter(
        (xxhash.xxh3_64_intdigest(word) for word in distinct), np.uint64, len(distinct)
    )
    return hashes[coded.indices.to_numpy()] if distinct else hashes


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each `width` consecutive entries; empty where there are fewer."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        total = hashes[:count].copy()
        for step in range(1, width):
            total = total * _MIX_A + hashes[step : step + count]
    return mix(total)


def map_batches(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """`mapInArrow` over small batches, so that memory follows CHUNK_BYTES and the longest text."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(function, schema)


@contextmanager
def brief_plans(spark: SparkSession) -> Iterator[None]:
    """Within, the driver keeps the beginnings of plan texts only. Steps that are repeated until
    nothing changes run hundreds of plans, and the driver remembers a text of each."""
    name = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "2000")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def text_key(column: str = "text"):
    """Tells texts of one doc_id apart without carrying them."""
    return F.xxhash64(F.col(column))
