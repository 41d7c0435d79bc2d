"""Connected components of an edge list, by rounds of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmart.llm.shared import keep


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node (above it, or below it) on the least of them.

    The least neighbour is a map-side combined minimum; joining it back keeps a
    node with very many neighbours from being gathered anywhere.
    """
    seen = _both_ways(edges)
    if not large:
        seen = seen.filter(F.col("b") < F.col("a"))
    least = seen.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    met = seen.join(least, F.col("a") == F.col("node"))
    if large:
        moved = met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is its least node.

    Large and small star rounds alternate until nothing changes, a number of
    rounds that grows with the logarithm of the longest chain. Each round is
    written to the shared folder.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = keep(edges.filter(F.col("a") != F.col("b")).distinct(), "edges")
    mark = _mark(now)
    while True:
        now = keep(_star(_star(now, large=True), large=False), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
