"""Connected components over links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.operators.joins import join_back
from carelake.session import stage


def connected_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component`` with the smallest node of each component as its name.

    ``nodes(node)`` distinct; ``links(a, b)`` undirected. Alternates the large-star and
    small-star steps of Kiveris et al., "Connected Components in MapReduce and Beyond"
    (2014), which end with a star around the smallest node after a number of rounds that
    grows with the logarithm of the size, not with the length of the longest chain. A step
    needs only the minimum of a node's neighbours, never the list of them. Every round is
    written to the shared folder, which cuts the lineage.
    """
    edges = stage(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    settled = False
    while not settled:
        edges = stage(_small_star(stage(_large_star(edges), "large-star")), "small-star")
        settled = _are_stars(edges)
    return nodes.join(edges.select(F.col("u").alias("node"), "v"), "node", "left").select(
        "node", F.coalesce("v", "node").alias("component")
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node leads to one other at most, and that one nowhere."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    degrees = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return degrees.filter("out > 1 OR (out = 1 AND into = 1)").isEmpty()


def _with_smallest(pairs: DataFrame) -> DataFrame:
    # Names often begin alike; sorts compare the hash first, which seldom is equal.
    pairs = pairs.withColumn("h", F.xxhash64("u"))
    smallest = pairs.groupBy("h", "u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return join_back(pairs, smallest, ["h", "u"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour. There are as many
    edges as before; equal ones are left to the small star, which takes them out."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    with_smallest = _with_smallest(edges)
    neighbours = with_smallest.select(F.col("v").alias("u"), F.col("m").alias("v"))
    itself = with_smallest.select("u", F.col("m").alias("v"))
    return neighbours.unionByName(itself).filter("u <> v").distinct()
