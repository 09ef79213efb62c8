"""Connected components of a distributed edge list.

Rounds of large-star and small-star: each node's neighbours are linked to the smallest
label near it, until no edge changes.  Every round is an aggregation and a join over
edges and is written to the shared folder.  A hot node is one row of the aggregate, and
its edges are salted.  Rounds grow with the logarithm of a component's size, and only two
numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.llm.columns import salted, written


def _star(edges: DataFrame, both: bool) -> DataFrame:
    """Link neighbours to the least of a node's neighbourhood: the larger ones when
    ``both`` directions are looked at, else the smaller ones."""
    if both:
        arcs = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = arcs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = salted(arcs.filter("b > a"), near, ["a"], F.col("b")).select(
            F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        near = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = salted(edges, near, ["a"], F.col("b")).filter("b <> m").select(
            F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.union(near.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label) of every node in an edge of ``edges`` (a, b longs): label is the
    smallest node reachable.  Nodes without edges have no row."""
    now = written(spark, edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct(), "edges")
    before = None
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == tuple(sums):
            break
        before = tuple(sums)
        now = written(spark, _star(now, True), "large-star")
        now = written(spark, _star(now, False), "small-star")
    leaves = now.groupBy("a").agg(F.min("b").alias("label"))
    roots = leaves.select(F.col("label").alias("a"), "label").distinct()
    return leaves.union(roots).select(F.col("a").alias("node"), "label")
