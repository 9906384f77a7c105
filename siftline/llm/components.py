"""Connected components of a graph too large for one machine.

Alternating large-star and small-star steps: each points nodes at smaller
neighbours until every node points at the smallest of its component, that is
until the edges are stars.  The number of rounds grows with the logarithm of the
longest path.  Minima are partial
aggregates, and each step is a written table, so nodes with very many neighbours
are no hot spot and lost executors cost no more than a step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftline.llm.tables import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node to the smallest of the neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (a, b) are stars: no node has two centres or is a leaf and a centre."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))
    )
    roles = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return roles.filter("leaf + centre > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node reachable, for each node with a link.

    ``links`` has the columns a and b; order and repeats don't matter.
    """
    edges = stage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while not _settled(edges):
        edges = stage(_small_star(_large_star(edges)), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
