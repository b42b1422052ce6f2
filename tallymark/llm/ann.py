"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted on a bounded sample. Each vector goes to the list of its nearest
centroid and, where it lies near a boundary, is replicated to further lists whose distance is
within a ratio of the least. Lists of more than BLOCK_ROWS vectors are dealt into blocks, so
that no list is one task, however many vectors sit on one spot. A query walks a graph over
the centroids, which is small and goes to every task, to find the nearest lists: a fixed share
of all, so that recall does not fall as the lists grow in number. Those whose distance is too
large a multiple of that of the first few are pruned. Blocks return their best, which are
merged. Distances of results are Euclidean on the original vectors, in double precision.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.sources.tables import materialize

#: The centroids are fitted on so many vectors at most, those with the least hashes.
SAMPLE_ROWS = 20_000

#: Number of centroids: one for so many vectors, between the bounds. A query is sent to a share
#: of the lists, so the upper bound also keeps the rows sent for a query few.
LIST_ROWS = 100
MIN_LISTS, MAX_LISTS = 8, 256

#: A vector is replicated to at most so many lists, within this ratio of its least distance.
REPLICAS = 4
REPLICA_RATIO = 1.15

#: Lists a query reads at most: this share of all, and PROBES where the share is less. It reads
#: LEAST_PROBES, and beyond them none whose distance is more than PROBE_RATIO times that of the
#: last of these. (The nearest alone is no measure: a query may sit on its centroid.)
PROBE_SHARE = 0.25
PROBES = 48
PROBE_RATIO = 1.6
LEAST_PROBES = 8

BLOCK_ROWS = 2000
NEIGHBOURS = 16


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without a null or non-finite component."""
    # NaN and infinities fail the comparison with the largest float: NaN is greater than all
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Graph:
    """Centroids with links to their nearest, searched best-first from fixed entries."""

    def __init__(self, centroids: np.ndarray, neighbours: int = NEIGHBOURS) -> None:
        self.centroids = centroids
        self.norms = (centroids**2).sum(axis=1)
        count = len(centroids)
        apart = self.norms[:, None] + self.norms[None, :] - 2 * centroids @ centroids.T
        near = np.argsort(apart, axis=1, kind="stable")[:, : neighbours + 1]
        links: list[set[int]] = [set() for _ in range(count)]
        for node in range(count):
            for other in near[node].tolist():
                if other != node:
                    links[node].add(other)
                    links[other].add(node)
        # a ring keeps far groups of centroids reachable
        for node in range(count):
            links[node].add((node + 1) % count)
        self.links = [np.array(sorted(found - {node})) for node, found in enumerate(links)]
        self.entries = np.unique(np.linspace(0, count - 1, min(count, 16)).astype(int))

    def distances(self, vector: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        squared = ((self.centroids[nodes] - vector) ** 2).sum(axis=1)
        return np.sqrt(squared)

    def search(self, vector: np.ndarray, width: int) -> list[tuple[float, int]]:
        """The nearest `width` centroids found, nearest first."""
        seen = set(self.entries.tolist())
        start = [(float(d), int(n)) for d, n in zip(self.distances(vector, self.entries), self.entries)]
        ahead = sorted(start)
        best = [(-d, n) for d, n in ahead]
        heapq.heapify(best)
        while len(best) > width:
            heapq.heappop(best)
        heapq.heapify(ahead)
        while ahead:
            distance, node = heapq.heappop(ahead)
            if len(best) >= width and distance > -best[0][0]:
                break
            fresh = np.array([n for n in self.links[node].tolist() if n not in seen], dtype=int)
            if not len(fresh):
                continue
            seen.update(fresh.tolist())
            for d, n in zip(self.distances(vector, fresh).tolist(), fresh.tolist()):
                if len(best) < width or d < -best[0][0]:
                    heapq.heappush(ahead, (d, n))
                    heapq.heappush(best, (-d, n))
                    if len(best) > width:
                        heapq.heappop(best)
        return sorted((-d, n) for d, n in best)


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means; a centroid with no vector moves to half of the largest list, which evens lists out."""
    random = np.random.default_rng(seed)
    centroids = sample[random.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        apart = (centroids**2).sum(axis=1)[None, :] - 2 * sample @ centroids.T
        owner = apart.argmin(axis=1)
        sizes = np.bincount(owner, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, sample)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled, None]
        for empty, full in zip(np.flatnonzero(~filled), np.argsort(-sizes, kind="stable")):
            members = np.flatnonzero(owner == full)
            centroids[empty] = sample[random.choice(members)]
    return centroids


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _place(graph: Graph, replicas: int, ratio: float):
    """Adds the lists of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = min(replicas, len(graph.centroids))
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column("vector"))
            lists = []
            for start in range(0, len(vectors), 1024):
                block = vectors[start : start + 1024]
                squared = (block**2).sum(axis=1)[:, None] + graph.norms[None, :] - 2 * block @ graph.centroids.T
                apart = np.sqrt(np.maximum(squared, 0))
                near = np.argsort(apart, axis=1, kind="stable")[:, :width]
                for row, chosen in zip(apart, near):
                    lists.append([int(c) for c in chosen if row[c] <= ratio * row[chosen[0]] or c == chosen[0]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(lists, pa.list_(pa.int32()))],
                names=["vec_id", "vector", "lists"],
            )

    return run


def _route(graph: Graph, probes: int, least: int, ratio: float):
    """Adds the lists that a query reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = []
            for vector in _vectors(batch.column("vector")):
                found = graph.search(vector, min(probes, len(graph.centroids)))
                limit = ratio * found[min(least, len(found)) - 1][0]
                lists.append([n for at, (d, n) in enumerate(found) if at < least or d <= limit])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), pa.array(lists, pa.list_(pa.int32()))],
                names=["vec_id", "vector", "lists"],
            )

    return run


def probes_of(lists: int) -> int:
    """How many of so many lists a query reads at most."""
    return min(lists, max(PROBES, math.ceil(PROBE_SHARE * lists)))


def _vector_rows(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    vector = F.col(f"`{column}`")
    rows = vectors.filter(usable(vector)).select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), vector.cast("array<double>").alias("vector")
    )
    return rows.filter(F.col("vec_id").isNotNull())


def build_index(rows: DataFrame, list_rows: int = LIST_ROWS, sample_rows: int = SAMPLE_ROWS):
    """(graph, postings): postings holds list, block, vec_id, vector for every row and replica."""
    count = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector")
    points = np.array([r[0] for r in sample.toLocalIterator()], dtype=np.float64)
    points = np.unique(points, axis=0)
    lists = min(max(MIN_LISTS, count // list_rows), MAX_LISTS, len(points))
    graph = Graph(fit_centroids(points, lists))
    schema = "vec_id long, vector array<double>, lists array<int>"
    placed = rows.mapInArrow(_place(graph, REPLICAS, REPLICA_RATIO), schema)
    postings = placed.select(F.explode("lists").alias("list"), "vec_id", "vector")
    postings = materialize(postings, "postings")
    sizes = postings.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    sizes = F.broadcast(sizes)  # a row per centroid
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    return graph, postings.join(sizes, "list").withColumn("block", block).drop("blocks"), sizes


def _scan(top: int):
    """The best of one block for each of its queries."""

    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(block):
            points, ids = np.array(block["vector"].tolist()), block["vec_id"].to_numpy()
            for query_id, vector in zip(queries["query_id"], queries["vector"]):
                apart = np.sqrt(((points - np.asarray(vector)) ** 2).sum(axis=1))
                other = np.flatnonzero(ids != query_id)
                best = other[np.lexsort((ids[other], apart[other]))[:top]]
                out += [(query_id, ids[i], apart[i]) for i in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def nearest(
    vectors: DataFrame,
    queries: Column,
    top: int = 10,
    probes: int | None = None,
    ratio: float = PROBE_RATIO,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """The `top` nearest rows found for each query row: query_id, rank, vec_id, score.

    queries selects the query rows by a condition on vec_id. The score is the Euclidean
    distance; ties go to the smaller vec_id. Null or zero vectors, and those with a null or
    non-finite component, take no part, nor do rows without an id. probes is the number of lists
    a query reads at most; by default it grows with the lists (`probes_of`). A row that repeats id and
    vector counts once. All vectors have one length. Where the lists a query reads hold fewer
    rows than it needs it reads all lists, so no query gets fewer than there are. An empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    rows = materialize(_vector_rows(vectors, id_column, column).distinct(), "vectors")
    asked = rows.filter(queries)
    result = "query_id long, rank int, vec_id long, score double"
    if asked.isEmpty():
        return spark.createDataFrame([], result)
    graph, postings, sizes = build_index(rows)
    postings = materialize(postings, "posting-blocks")
    schema = "vec_id long, vector array<double>, lists array<int>"

    def search(asked: DataFrame, probes: int, least: int) -> DataFrame:
        routed = asked.mapInArrow(_route(graph, probes, least, ratio), schema)
        routed = routed.select(F.col("vec_id").alias("query_id"), "vector", F.explode("lists").alias("list"))
        routed = routed.join(sizes, "list").withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        )
        found = (
            routed.select("list", "block", "query_id", "vector")
            .groupBy("list", "block")
            .cogroup(postings.groupBy("list", "block"))
            .applyInPandas(_scan(top), "query_id long, vec_id long, score double")
        )
        found = found.dropDuplicates(["query_id", "vec_id", "score"])
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= top)
        return materialize(found.select("query_id", "rank", "vec_id", "score"), "nearest")

    found = search(asked, probes or probes_of(len(graph.centroids)), LEAST_PROBES)
    full = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= top)
    short = asked.join(full, asked["vec_id"] == full["query_id"], "left_anti")
    if short.isEmpty():
        return found
    again = search(short, len(graph.centroids), len(graph.centroids))
    kept = found.join(full.select("query_id"), "query_id", "left_semi")
    return kept.select("query_id", "rank", "vec_id", "score").unionByName(again)
