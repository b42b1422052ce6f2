"""Connected components of a link table, as repeated joins.

Large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014) rewire the links until every node hangs on the least node of its component.
Each step is one aggregate and one inner join, so a node with very many links is reduced
before the shuffle and its rows are split by adaptive execution. No step emits more rows
than it reads, and the number of steps grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.sources.tables import materialize


def _least(links: DataFrame) -> DataFrame:
    """Links (node, other) with the least node among `node` and all its others."""
    least = links.groupBy("node").agg(F.min("other").alias("low"))
    least = least.select(F.col("node").alias("of"), F.least("node", "low").alias("low"))
    return links.join(least, F.col("node") == F.col("of")).select("node", "other", "low")


def _each(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Rows (node, other) of the pairs of columns, all from one pass: a union would read, and
    compute, what it stands on once for each."""
    ends = F.array(*[F.struct(F.col(a).alias("node"), F.col(b).alias("other")) for a, b in pairs])
    return rows.select(F.explode(ends).alias("link")).select("link.*")


def _large_star(links: DataFrame) -> DataFrame:
    both = _each(links, ("node", "other"), ("other", "node"))
    moved = _least(both).filter(F.col("other") > F.col("node"))
    return moved.select(F.col("other").alias("node"), F.col("low").alias("other"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(
        F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")
    )
    return _each(_least(down), ("other", "low"), ("node", "low"))


def _all_stars(links: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none. Links are distinct, and lead to
    a lesser node."""
    ends = F.array(
        F.struct(F.col("node").alias("end"), F.lit(1).alias("up")),
        F.struct(F.col("other").alias("end"), F.lit(0).alias("up")),
    )
    ends = links.select(F.explode(ends).alias("e")).select("e.*")
    counted = ends.groupBy("end").agg(F.sum("up").alias("ups"), F.count("*").alias("links"))
    return counted.filter("ups > 0 and links > 1").isEmpty()


def stars(links: DataFrame) -> DataFrame:
    """(node, component) for every node but the least of each component, which is its name.

    links has columns node and other of one orderable type. Self links, repeated links and
    either direction are fine; a null end links nothing. An empty table gives no rows.
    """
    links = links.select("node", "other").filter(F.col("node") != F.col("other"))
    links = materialize(links, "links")
    while True:
        links = _small_star(_large_star(links)).filter(F.col("node") != F.col("other")).distinct()
        links = materialize(links, "links")
        if _all_stars(links):
            break
    return links.select("node", F.col("other").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; the component is its least node.
    links: as of `stars`."""
    hung = stars(links)
    roots = hung.select("component").distinct()
    return hung.unionByName(roots.select(F.col("component").alias("node"), "component"))
