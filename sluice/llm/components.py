"""Connected components by alternating large and small stars, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import written


def _stars(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_stars(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, are tied to the least of them; edges run from large to small."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    ties = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
    return ties.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """For ``links`` (a, b; in any direction, repeats allowed): each node with a smaller one in its component, as
    (node, component), where the component is its least node. Nodes that are least themselves have no row.

    The number of rounds grows with the logarithm of the longest path; each is written, so that no lineage builds up.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    while True:
        edges = written(_small_stars(_stars(edges)), "stars")
        # Done when every node hangs on one other, and that one on none.
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        state = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if state.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
