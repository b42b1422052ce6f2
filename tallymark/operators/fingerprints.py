"""Bags of keys compared by fingerprints of hash ranges.

Two bags are equal if in every range of key hashes both hold as many keys and the same sum of
hashes, 128 bits wide. Sums do not care for order and add up over tasks, so a task sends a few
numbers for each range, not its keys. Only the ranges that differ are looked at again, first in
finer ranges and at last key by key: where both sides are equal no key is exchanged at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.checks import bag_difference

#: Hexadecimal digits of the key's hash that a level of ranges adds: 256 ranges within each.
LEVEL_DIGITS = 2
LEVELS = 2

#: Ranges of one level that are looked at further by name; beyond, all are.
NAMED = 4_096


def key_range(key: str, digits: int) -> Column:
    """The range a key falls into; a null key has a range of its own."""
    return F.coalesce(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, digits), F.lit("-"))


def _marked(rows: DataFrame, key: str, side: int) -> DataFrame:
    return rows.select(F.col(key).alias("key"), F.lit(side).cast("bigint").alias("side"))


def range_fingerprints(expected: DataFrame, found: DataFrame, key: str, digits: int) -> DataFrame:
    """(range, expected, found, differs): rows of both sides and whether their bags differ. One
    aggregate over both sides, whose exchange has a row per range and task."""
    both = _marked(expected, key, 1).unionByName(_marked(found, key, -1))
    halves = [F.xxhash64("key"), F.xxhash64(F.lit("other half"), "key")]
    drift = [F.sum((half.cast("decimal(20,0)") * F.col("side")).cast("decimal(38,0)")) for half in halves]
    sums = both.groupBy(key_range("key", digits).alias("range")).agg(
        F.count_if(F.col("side") == 1).alias("expected"),
        F.count_if(F.col("side") == -1).alias("found"),
        *[d.alias(f"drift_{i}") for i, d in enumerate(drift)],
    )
    differs = (F.col("expected") != F.col("found")) | (F.col("drift_0") != 0) | (F.col("drift_1") != 0)
    return sums.select("range", "expected", "found", differs.alias("differs"))


def differing_ranges(expected: DataFrame, found: DataFrame, key: str, levels: int = LEVELS) -> DataFrame:
    """(range, expected, found) of the finest ranges whose bags differ; none if the bags are
    equal. From the second level on only rows of ranges that differ are read on."""
    inside = None
    for level in range(1, levels + 1):
        ranges = range_fingerprints(_within(expected, key, inside), _within(found, key, inside), key, level * LEVEL_DIGITS)
        off = ranges.where("differs").drop("differs")
        if level == levels:
            return off
        inside = [r["range"] for r in off.select("range").limit(NAMED + 1).collect()]
        if not inside:
            return off
        inside = None if len(inside) > NAMED else inside
    raise ValueError("at least one level")


def _within(rows: DataFrame, key: str, ranges: list[str] | None) -> DataFrame:
    if ranges is None:
        return rows
    digits = max(len(r) for r in ranges)
    return rows.where(key_range(key, digits).isin(ranges))


def bag_difference_by_ranges(expected: DataFrame, found: DataFrame, key: str, levels: int = LEVELS) -> DataFrame:
    """`bag_difference` of keys in differing ranges only, which is all of it."""
    ranges = differing_ranges(expected, found, key, levels).select("range")
    names = [r["range"] for r in ranges.limit(NAMED + 1).collect()]
    if len(names) <= NAMED:
        sides = [_within(rows, key, names) if names else rows.limit(0) for rows in (expected, found)]
    else:
        at = key_range(key, levels * LEVEL_DIGITS).alias("range")
        sides = [rows.withColumn("range", at).join(F.broadcast(ranges), "range", "semi") for rows in (expected, found)]
    return bag_difference(*sides, key)
