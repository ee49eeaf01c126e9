"""Connected components of an edge table, by alternating star rounds.

Each round lets every node point at the smallest node it touches: first its
larger neighbours (large star), then itself and its smaller ones (small star).
The edges shrink to stars whose centres are the components' smallest nodes; the
number of rounds grows with the logarithm of a component's diameter, and a
round ends the loop as soon as only stars are left. A node's neighbours are
only ever reduced to their minimum (a map-side partial aggregate). The minima are
written down and joined back: by a broadcast while they are measured to be small, else
by a join for which both sides are dealt anew, so that AQE can split a hub of any degree.

Defined cases: loops are dropped, repeated edges count once, ties can't arise, and
an empty table has no components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.session import checkpointed, sized


def _only_stars(edges: DataFrame) -> bool:
    """Whether every edge (a, b) joins a node of no other edge to the centre of its star."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))
    )
    per_node = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return per_node.where("leaf > 1 OR leaf + centre > 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = sized(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges point from the larger node to the smaller: a > b.
    low = sized(edges.groupBy("a").agg(F.min("b").alias("m")))
    met = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return met.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of an edge (columns a, b; any order, loops allowed) the smallest node it reaches."""
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _only_stars(now):
        now = checkpointed(_small_star(checkpointed(_large_star(now))))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
