"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import drop_table
from logweave.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v) that has a link; the component is its smallest node.

    A step is written as one table (so a lost executor costs one step at most).
    Done when all is stars: no node is both a centre and a leaf, and none has two centres.
    """
    now = materialize(edges.filter("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")), "cc")
    while True:
        # a star forest has one edge per leaf, and no centre among the leaves
        leaves = now.groupBy("u").agg(F.count("*").alias("n"))
        centres = now.select(F.col("v").alias("u")).distinct().withColumn("centre", F.lit(1))
        odd = leaves.join(centres, "u", "left").filter("n > 1 or centre = 1")
        if odd.isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        nxt = materialize(_small_star(_large_star(now)), "cc")
        drop_table(now)
        now = nxt
