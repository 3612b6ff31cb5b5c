"""Connected components by alternating large-star and small-star steps on written tables.

Every round groups edges by a node and points the node's neighbours at the least of them.  Nodes with very many
neighbours are reduced by partial aggregation and joined back by broadcast (see ``attach``), so no task gathers one.
Rounds grow with the logarithm of the graph; each is written to the shared folder, so a lost executor repeats at most
one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, durable


def _sign(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()


def _large(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("c"))
    return attach(both, least, "u", "c", 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame, n: int) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c"))
    moved = attach(edges, least, "u", "c", n).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long).  Returns node, component (the least node it reaches) for every node of an edge that isn't a loop."""
    now = durable(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    sign = _sign(now)
    while sign["n"]:
        big = durable(_large(now, sign["n"]), "large-star")
        now = durable(_small(big, big.count()), "small-star")
        new = _sign(now)
        if new == sign:
            break
        sign = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def least_ids(classes: DataFrame, tree: DataFrame, own: str) -> DataFrame:
    """classes (rep and others) with ``component_id``: the least ``own`` (a number, or a struct that holds it) of all classes in a class's
    component, its own where it has no edge."""
    placed = durable(classes.join(tree.select(F.col("node").alias("rep"), "component"), "rep", "left"), "placed")
    joined = placed.filter("component IS NOT NULL")
    least = durable(joined.groupBy("component").agg(F.min(own).alias("component_id"), F.count("*").alias("size")), "components")
    named = attach(joined, least, "component", "size", joined.count(), "inner").drop("component", "size")
    return named.unionByName(placed.filter("component IS NULL").drop("component").withColumn("component_id", F.col(own)))
