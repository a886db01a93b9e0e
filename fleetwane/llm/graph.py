"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwane.session import store


def _done(edges: DataFrame) -> bool:
    """Every node has one parent, and no parent has one."""
    parents = edges.select(F.col("b").alias("p")).distinct()
    inner = edges.join(parents, F.col("a") == F.col("p"), "left_semi").limit(1).count()
    return not inner and edges.groupBy("a").count().filter("count > 1").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b) links; the component is its smallest node.

    Each round joins the links with one row per node, so a node with very many links is only
    a skewed key of a join. Links between the same nodes, both ways and to itself are fine.
    """
    current = store(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _done(current):
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = store(large, "large")
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_least, "a")
        small = joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(small_least.select("a", F.col("m").alias("b")))
        current = store(small.distinct(), "links")
    own = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(own)
