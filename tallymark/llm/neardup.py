"""Near-duplicate documents: one-permutation MinHash, banded buckets, star-shaped candidates.

1. Every whole text becomes its set of shingles (hashes of 5 consecutive words). Texts with
   equal sets form one class, told by a 128-bit digest of the sorted set; from here on a
   class is one node, so exact copies cost nothing more.
2. One-permutation hashing: the hash range is cut into BANDS * ROWS bins, the least hash of
   each bin is kept. An empty bin borrows from a bin drawn by a hash of its own number and
   the attempt ("optimal densification", Shrivastava 2017), so that equal sets agree and the
   chance of agreement in a bin stays the Jaccard similarity.
3. ROWS bins make a band, a band's hash is a bucket. There are as many bands as keep a pair
   just at the asked similarity from missing all of them, but for MISSED (`bands_of`): 32 bands
   of 6 rows at 0.85, 50 at 0.80.
4. In each bucket all members are compared with one hub only (a star), on their full sets.
5. What a star may miss is found exactly. Of all nodes in buckets that still hold several
   components, the shingles are ordered from rare to common, and each node keeps the first
   n - ceil(similarity * n) + 1 of its n: two sets of that similarity share one of them (the prefix
   filter of set similarity joins). Nodes with a common prefix shingle form a group; its
   members become hubs, in growing numbers, until every two of a group are in one component,
   were compared, or differ too much in size.

Links are joined to components by joins (`stars`). Nothing is collected to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.components import stars
from tallymark.llm.text import brief_plans, chunks, map_batches, mix, split_words, text_key, windows, word_hashes
from tallymark.sources.tables import materialize


WIDTH = 5
BANDS = 32
ROWS = 6

#: The chance at most that a pair of just the asked similarity shares no band.
MISSED = 3e-7

#: Attempts tabulated for the densification; a bin that needs more takes the first full bin.
ATTEMPTS = 4096

#: Hubs a group may get in each round after the star: FIRST_HUBS, then times HUB_GROWTH.
FIRST_HUBS = 32
HUB_GROWTH = 32


# --- sets and signatures, inside tasks


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z lower-cased. A text of fewer
    words has its whole sequence as one shingle, one without words the empty set."""
    words, starts = split_words(pc.ascii_lower(pc.fill_null(texts, "")))
    hashes = word_hashes(words)
    every = windows(hashes, width)
    sets = []
    for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if end - start >= width:
            sets.append(np.unique(every[start : end - width + 1]))
        else:
            sets.append(windows(hashes[start:end], end - start) if end > start else every[:0])
    return sets


def _donors(bins: int) -> np.ndarray:
    """The bin that each empty bin asks at each attempt."""
    asked = np.arange(ATTEMPTS * bins, dtype=np.uint64).reshape(ATTEMPTS, bins)
    return (mix(asked) % np.uint64(bins)).astype(np.int32)


def bands_of(percent: int, rows: int = ROWS) -> int:
    """The least number of bands that a pair of this similarity misses no oftener than MISSED."""
    same = min(percent / 100, 0.99) ** rows
    return math.ceil(math.log(MISSED) / math.log1p(-same))


class Signer:
    """Band hashes of shingle sets."""

    def __init__(self, bands: int, rows: int) -> None:
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        self.donors = _donors(self.bins)
        self.edges = np.array(
            [(bin << 64) // self.bins for bin in range(self.bins)], dtype=np.uint64
        )
        self.salt = mix(np.arange(bands, dtype=np.uint64))

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        first = np.searchsorted(shingles, self.edges)
        after = np.append(first[1:], len(shingles))
        full = after > first
        least = shingles[np.minimum(first, len(shingles) - 1)]
        source = np.arange(self.bins)
        empty = np.flatnonzero(~full)
        attempt = 0
        while len(empty) and attempt < ATTEMPTS:
            asked = self.donors[attempt, empty]
            found = full[asked]
            source[empty[found]] = asked[found]
            empty = empty[~found]
            attempt += 1
        source[empty] = np.flatnonzero(full)[0]
        values = least[source].reshape(self.bands, self.rows)
        with np.errstate(over="ignore"):
            total = self.salt.copy()
            for row in range(self.rows):
                total = mix(total * np.uint64(31) + values[:, row])
        return total.view(np.int64)


def _sign(width: int, bands: int, rows: int):
    names = ["doc_id", "text_key", "n_shingles", "node", "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(bands, rows)
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = shingle_sets(part.column("text"), width)
                nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                buckets = [signer(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(nodes, pa.binary()),
                        pa.array(buckets, pa.list_(pa.int64())),
                    ],
                    names=names,
                )

    return run


def _as_sets(width: int):
    """Rows (node, text) to (node, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = [s.view(np.int64) for s in shingle_sets(part.column("text"), width)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.array(sets, pa.list_(pa.int64()))],
                    names=["node", "shingles"],
                )

    return run


# --- tables


def signatures(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, node (null without words), buckets."""
    narrow = docs.select("doc_id", text_key().alias("text_key"), "text")
    schema = "doc_id long, text_key long, n_shingles long, node binary, buckets array<long>"
    return map_batches(narrow, _sign(width, bands, rows), schema)


def full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the first document of each class in `nodes`."""
    first = classes.join(nodes, "node").select("node", "doc", "key")
    texts = docs.select("doc_id", text_key().alias("text_key"), "text").join(
        first, (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("doc"))
    )
    texts = texts.select("node", "text")
    return map_batches(texts, _as_sets(width), "node binary, shingles array<long>")


class _Matcher:
    """Compares nodes on their full sets, each pair once."""

    def __init__(self, sets: DataFrame, percent: int) -> None:
        self.sets, self.percent = sets, percent
        self.known: list[DataFrame] = []

    def __call__(self, pairs: DataFrame, name: str) -> DataFrame:
        """pairs (a, b) with shared and total of those not compared before."""
        pairs = pairs.select("a", "b").distinct()
        for known in self.known:
            pairs = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
        left = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set"))
        right = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set"))
        shared = F.size(F.array_intersect("a_set", "b_set")).cast("long")
        compared = pairs.join(left, "a").join(right, "b").select(
            "a", "b", shared.alias("shared"), (F.size("a_set") + F.size("b_set")).alias("sum")
        )
        compared = compared.select("a", "b", "shared", (F.col("sum") - F.col("shared")).alias("total"))
        compared = materialize(compared, f"compared-{name}")
        self.known.append(compared)
        return compared

    def near(self, compared: DataFrame) -> DataFrame:
        """Links (node, other) of the pairs that reach the similarity."""
        reached = F.col("shared") * 100 >= F.lit(self.percent) * F.col("total")
        return compared.filter(reached).select(F.col("a").alias("node"), F.col("b").alias("other"))


def _size_fits(percent: int):
    """Sets whose sizes differ more than this can't reach the similarity."""
    low, high = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    return low * 100 >= F.lit(percent) * high


def _place_fits(percent: int):
    """If this shingle is the first that two sets share, no more than what follows it in
    both can be shared (if it isn't, the pair meets in the group of an earlier one)."""
    most = F.least(F.col("a_size") - F.col("place"), F.col("b_size") - F.col("b_place")) + 1
    return most * 100 >= F.lit(percent) * (F.col("a_size") + F.col("b_size") - most)


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with the component of their node: its own, where it has no link yet."""
    return rows.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )


def _unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component, in groups that hold more than one component, and how many
    members of the group have not been hubs (`done`, where there is that column)."""
    labelled = _labelled(members, labels)
    waiting = F.count_if(~F.col("done")) if "done" in members.columns else F.count("*")
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), waiting.alias("waiting"))
        .filter(F.col("low") != F.col("high"))
        .select("bucket", "waiting")
    )
    return labelled.join(mixed, "bucket")


def _prefix_groups(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, size, place): nodes by each shingle of their prefix that another node
    has, with the shingle's place in the node's order."""
    each = sets.join(nodes, "node").select(
        "node", F.size("shingles").alias("size"), F.explode("shingles").alias("bucket")
    )
    counts = each.groupBy("bucket").agg(F.count("*").alias("holders"))
    shared = each.join(counts.filter(F.col("holders") > 1), "bucket")
    # shingles of one holder come first in the order: only their number matters
    rank = F.row_number().over(Window.partitionBy("node").orderBy("holders", "bucket"))
    placed = shared.withColumn("rank", rank).withColumn(
        "common", F.count("*").over(Window.partitionBy("node"))
    )
    kept = F.ceil(F.col("size") * percent / 100)
    prefix = F.col("size") - kept + 1
    placed = placed.withColumn("place", (F.col("rank") + F.col("size") - F.col("common")).cast("int"))
    return placed.filter(F.col("place") <= prefix).select("bucket", "node", "size", "place")


def _settle(rest: DataFrame, match: _Matcher, labels: DataFrame) -> DataFrame:
    """Labels after every pair of a group is in one component, compared, or too unlike in size."""
    rest = rest.withColumn("done", F.lit(False))
    allowed = FIRST_HUBS
    while True:
        state = materialize(_unsettled(rest, labels), "unsettled")
        order = F.xxhash64("node", "bucket")
        waiting = state.filter(~F.col("done")).withColumn("order", order)
        # a group with no more members than hubs it may get has them all as hubs at once
        slot = F.when(F.col("waiting") > allowed, F.pmod("order", F.lit(allowed))).otherwise(F.col("order"))
        hubs = waiting.groupBy("bucket", slot.alias("slot")).agg(
            F.min(F.struct("order", "node", "size", "place", "component")).alias("h")
        )
        hubs = hubs.select(
            "bucket",
            F.col("h.node").alias("b"),
            F.col("h.size").alias("b_size"),
            F.col("h.place").alias("b_place"),
            F.col("h.component").alias("b_component"),
        )
        hubs = materialize(hubs, "hubs")
        if hubs.isEmpty():
            return labels
        members = state.select("bucket", F.col("node").alias("x"), F.col("size").alias("a_size"), "place", "component")
        pairs = members.join(hubs, "bucket").filter(
            (F.col("component") != F.col("b_component")) & _place_fits(match.percent)
        )
        found = match(pairs.select(F.greatest("x", "b").alias("a"), F.least("x", "b").alias("b")), "rest")
        near = match.near(found)
        if not near.isEmpty():
            # the labels stand for all links before
            before = labels.select("node", F.col("component").alias("other"))
            labels = stars(before.unionByName(near))
        used = hubs.select("bucket", F.col("b").alias("node"), F.lit(True).alias("used"))
        rest = state.select("bucket", "node", "size", "place", "done").join(used, ["bucket", "node"], "left")
        rest = rest.select(
            "bucket", "node", "size", "place", (F.col("done") | F.col("used").isNotNull()).alias("done")
        )
        allowed *= HUB_GROWTH


def link_nodes(docs: DataFrame, signed: DataFrame, percent: int, width: int) -> DataFrame:
    """(node, component) of all nodes that links lead on from to a lesser one; the others are
    components of their own name. signed: a table as of `signatures`."""
    real = signed.filter(F.col("node").isNotNull())
    classes = real.groupBy("node").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.max("n_shingles").alias("size")
    )
    classes = classes.select(
        "node", F.col("first.doc_id").alias("doc"), F.col("first.text_key").alias("key"), "size"
    )
    classes = materialize(classes, "classes")
    # buckets of one row per class: that of its first document
    firsts = real.join(
        classes.select(F.col("node").alias("of"), "doc", "key"),
        (F.col("node") == F.col("of"))
        & (F.col("text_key") == F.col("key"))
        & F.col("doc_id").eqNullSafe(F.col("doc")),
    )
    members = firsts.select(
        F.explode("buckets").alias("bucket"), "node", F.col("n_shingles").cast("int").alias("size")
    )
    # the size comes along: a hub with very many followers has to meet them in no other join
    hubs = (
        members.groupBy("bucket")
        .agg(F.min(F.struct("node", "size")).alias("least"), F.max("node").alias("last"))
        .filter(F.col("least.node") != F.col("last"))
        .select("bucket", F.col("least.node").alias("hub"), F.col("least.size").alias("b_size"))
    )
    members = materialize(members.join(hubs, "bucket").distinct(), "members")
    nodes = members.select("node").distinct()
    sets = full_sets(docs, classes, nodes, width).dropDuplicates(["node"])
    sets = materialize(sets, "sets")

    match = _Matcher(sets, percent)
    star = members.filter(F.col("node") != F.col("hub"))
    star = star.withColumn("a_size", F.col("size")).filter(_size_fits(percent))
    compared = match(star.select(F.col("node").alias("a"), F.col("hub").alias("b")), "star")
    labels = stars(match.near(compared))

    open_nodes = _unsettled(members.select("bucket", "node"), labels).select("node").distinct()
    rest = materialize(_prefix_groups(open_nodes, sets, percent), "rest")
    return _settle(rest, match, labels)


def near_duplicates(
    docs: DataFrame,
    percent: int = 85,
    width: int = WIDTH,
    bands: int | None = None,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_key.

    Two documents are linked when 100 * shared >= percent * all of their shingles; component_id
    is the least doc_id that links lead to, kept marks the document with that id. A document
    without words (or text) is linked with nothing. Equal rows share a component and are all
    kept if the first is. A null doc_id never is a component_id unless its component has no
    other: then component_id is null and the rows are kept. Other columns are not read; an
    empty table gives no rows. The bands follow from percent where none are given: a pair at
    exactly percent shares no bucket, and is then not seen, with a chance of at most MISSED.
    """
    placed = _placed(docs, percent, width, bands, rows)
    return placed.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "text_key",
    )


def _placed(docs: DataFrame, percent: int, width: int, bands: int | None, rows: int) -> DataFrame:
    """doc_id, text_key, n_shingles, component (null without words), component_id of each row."""
    with brief_plans(docs.sparkSession):
        signed = materialize(signatures(docs, width, bands or bands_of(percent, rows), rows), "signatures")
        labels = link_nodes(docs, signed, percent, width)
    narrow = signed.select("doc_id", "text_key", "n_shingles", "node")
    classes = narrow.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = classes.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    named = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(named, "component").select("node", "component", "component_id")
    # nodes are hashed sets: a class with very many copies is split by adaptive execution
    placed = narrow.filter(F.col("node").isNotNull()).join(classes, "node").drop("node")
    alone = narrow.filter(F.col("node").isNull()).withColumn("component_id", F.col("doc_id"))
    return placed.unionByName(alone.drop("node"), allowMissingColumns=True)


def drop_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One document of each component, all columns: that of the least doc_id, a null one last,
    and of several texts under it the one of the least hash. Rows without words (or text) are
    linked with nothing; of rows that repeat doc_id and text one stays, whichever. An empty
    table stays empty."""
    placed = _placed(docs, percent, WIDTH, None, ROWS)
    first = placed.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    own = F.when(F.col("component").isNull(), F.struct("doc_id", "text_key"))
    kept = first.groupBy("component", own.alias("own")).agg(
        F.min("doc_id").alias("doc_id"), F.min("text_key").alias("text_key"), F.count("*").alias("rows")
    )
    kept = materialize(kept.select("doc_id", F.col("text_key").alias("key"), "rows"), "kept")
    key = "text_key"
    while key in docs.columns:
        key = f"{key}_"

    def rows_of(chosen: DataFrame) -> DataFrame:
        keyed = docs.withColumn(key, text_key())
        same = keyed["doc_id"].eqNullSafe(chosen["doc_id"]) & (keyed[key] == chosen["key"])
        return keyed.join(chosen, same, "left_semi")

    found = rows_of(kept.filter("rows = 1"))
    repeated = kept.filter("rows > 1")
    if not repeated.isEmpty():
        found = found.unionByName(rows_of(repeated).dropDuplicates(["doc_id", key]))
    return found.drop(key)
