"""Mixing sources to target weights by distributed prefix sums.

Every document gets a hash-random key. Inside each source the documents stand in the order
of their keys, cut into ranges by the key's leading digits: a uniform key makes the ranges
even, so no sampling is needed and no source, however large, meets in one task. Sums per
(source, range) are few; their running totals give each range its offset, and a window
inside the range gives each document its own. The mix takes the documents of a source in
that order up to the source's exact budget of words, going round again where the budget is
larger than the source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.text import chunks, map_batches, split_words, text_key
from tallymark.sources.tables import materialize

WEIGHTS = (3.0, 1.0, 2.0)

#: Hexadecimal digits of the key that name a range: 4,096 ranges in each source.
RANGE_DIGITS = 3


#: Equal rows that one task puts out; more are dealt over tasks.
COPIES = 100_000


def random_key(seed: str) -> Column:
    """A hash-random key that only the document's id, its text and the seed decide, so that
    neither an id nor a text that many rows share brings them together."""
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))]
    return F.md5(F.concat(F.lit(f"{seed}:"), *parts).cast("binary"))


def source_key() -> Column:
    """Sorts as the source does by code point, a null source last."""
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit("t"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            _, starts = split_words(part.column("text"))
            columns = [c for name, c in zip(part.schema.names, part.columns) if name != "text"]
            names = [name for name in part.schema.names if name != "text"]
            sizes = pa.array(starts[1:] - starts[:-1], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, sizes], names=[*names, "size"])


def sizes(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, text_key, key, source, size (words of the whole text; 0 for null)."""
    narrow = docs.select("doc_id", text_key().alias("text_key"), random_key(seed).alias("key"), "source", "text")
    return map_batches(narrow, _count, "doc_id long, text_key long, key string, source string, size long")


def targets(totals: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(src, source_size, target): totals holds (src, size) sums, one or more per source.

    Each source's share of `share` times all words goes by its weight; the weights are dealt
    out in the order of the sources, again and again. No target passes `most` times the
    source's size: with the sources in the order of limit by weight, the level at which the
    remaining words fill the remaining weights rises up to the first source that is not
    limited and falls after it, so its maximum is the level of all that are not.
    """
    sources = totals.groupBy("src").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy("src")) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    sources = sources.withColumn("weight", weight)
    sources = sources.withColumn("limit", F.col("source_size") * F.lit(float(most)))
    rising = Window.orderBy(F.col("limit") / F.col("weight"), "src")
    everything = Window.partitionBy(F.lit(1))
    taken = F.coalesce(F.sum("limit").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    wanted = F.sum("source_size").over(everything) * F.lit(float(share))
    sources = sources.withColumn("level", (wanted - taken) / open_weight)
    level = F.max("level").over(everything)
    return sources.select(
        "src", "source_size", F.least("limit", level * F.col("weight")).alias("target")
    )


def plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """How many words of each document the mix takes.

    Columns: doc_id, text_key, source, key, size, source_size, target, budget, before, taken.
    budget is the target in whole words; before counts the words of the source in front of
    the document in the key's order; taken sums to the budget in every source. A document
    without words gives none. Equal rows (of one id, text and source) are one entry with a number of
    copies until the plan is made, and take one after the other; nothing tells which of them is
    cut. Null ids, texts and sources are values of their own. An empty table gives no rows.
    """
    rows = sizes(docs, seed).withColumn("src", source_key())
    entry = ["src", "source", "key", "doc_id", "text_key", "size"]
    rows = rows.groupBy(*entry).agg(F.count("*").alias("copies"))
    rows = rows.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    rows = materialize(rows.withColumn("words", F.col("size") * F.col("copies")), "sizes")
    ranges = rows.groupBy("src", "range").agg(F.sum("words").alias("size"))
    goal = targets(ranges, weights, share, most)
    ahead = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        "src", "range", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("range_start")
    ).join(goal, "src")
    inside = (
        Window.partitionBy("src", "range")
        .orderBy("key", "doc_id", "text_key", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.join(offsets, ["src", "range"]).withColumn(
        "before", F.col("range_start") + F.coalesce(F.sum("words").over(inside), F.lit(0))
    )
    placed = _one_by_one(placed, rows)
    budget = F.floor(F.col("target") + 0.5).cast("long")
    placed = placed.withColumn("budget", budget)
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    placed = placed.withColumn("epochs", epochs)
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before")
    placed = placed.withColumn(
        "taken",
        F.col("epochs") * F.col("size") + F.least(F.greatest(rest, F.lit(0)), F.col("size")),
    )
    return placed.select(
        "doc_id", "text_key", "source", "key", "size", "source_size", "target", "budget",
        "epochs", "before", "taken",
    )


def _one_by_one(placed: DataFrame, counted: DataFrame) -> DataFrame:
    """A row for each copy, each behind the one before it. Where an entry has more copies than a
    task should put out, stretches of copies are dealt over tasks first."""
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long")))
    placed = placed.withColumn("first", stretch)
    if (counted.agg(F.max("copies")).first()[0] or 0) > COPIES:
        placed = placed.repartition("key", "first")
    last = F.least(F.col("first") + COPIES, F.col("copies")) - 1
    placed = placed.withColumn("copy", F.explode(F.sequence("first", last)))
    return placed.withColumn("before", F.col("before") + F.col("copy") * F.col("size"))


def _first_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts cut behind their first `cut` words."""
    for batch in batches:
        at, texts = batch.schema.get_field_index("text"), []
        for text, cut in zip(batch.column("text").to_pylist(), batch.column("cut").to_pylist()):
            raw = text.encode()
            rest = raw.split(None, cut)[cut:]
            texts.append((raw[: len(raw) - len(rest[0])] if rest else raw).decode())
        columns = list(batch.columns)
        columns[at] = pc.cast(pa.array(texts, pa.string()), batch.schema.field(at).type)
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """The mixed documents, in the columns of `docs`: a document once for each time it is taken
    whole, and the last of a source's order cut behind the words that fill the budget.

    The plan is boiled down to one row per source, the place of its cut, so that texts are
    not shuffled. Equal rows that share the place of the cut share the rest of the budget.
    Documents without words go; a null doc_id or source is a value of its own, a text of any
    length is cut in its task, and an empty table stays empty.
    """
    columns = docs.columns
    planned = materialize(plan(docs, weights, share, most, seed), "mix-plan")
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    planned = planned.withColumn("rest", rest).withColumn("src", source_key())
    sources = planned.groupBy("src").agg(F.max("epochs").alias("epochs"), F.max("rest").alias("rest"))
    place = F.struct("key", "doc_id", "text_key")
    last = planned.filter((F.col("size") > 0) & (F.col("before") < F.col("rest")))
    cuts = last.groupBy("src").agg(F.max(place).alias("cut_at"))
    words = last.join(cuts, "src").filter(place.eqNullSafe(F.col("cut_at"))).groupBy("src").agg(
        F.sum(F.least("size", F.col("rest") - F.col("before"))).alias("cut_words"),
    )
    equal = planned.join(cuts, "src").filter(place.eqNullSafe(F.col("cut_at")))
    equal = equal.groupBy("src").agg(F.count("*").alias("cut_rows"))
    marks = sources.join(cuts, "src", "left").join(words, "src", "left").join(equal, "src", "left")
    marks = materialize(marks.withColumnRenamed("src", "mix_src"), "mix-cuts")

    inner = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        source_key().alias("mix_src"),
        F.struct(random_key(seed).alias("key"), "doc_id", text_key().alias("text_key")).alias("at"),
    ).join(marks, "mix_src")
    copies = F.col("epochs") + F.coalesce((F.col("at") < F.col("cut_at")).cast("long"), F.lit(0))
    whole = inner.withColumn("mix_copy", F.explode(F.sequence(F.lit(0), copies)))
    whole = whole.filter(F.col("mix_copy") > 0).select("row.*")
    cut = F.floor(F.col("cut_words") / F.col("cut_rows")).cast("long")
    partial = inner.filter(F.col("at").eqNullSafe(F.col("cut_at"))).withColumn("cut", cut)
    partial = partial.filter(F.col("cut") > 0).select("row", "cut", F.col("row.text").alias("text"))
    schema = partial.schema
    partial = map_batches(partial, _first_words, schema)
    kept = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns]
    mixed = whole.unionByName(partial.select(*kept))
    if "n_chars" in columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed
