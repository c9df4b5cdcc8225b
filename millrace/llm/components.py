"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour or itself."""
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(least, both["u"] == least["w"]).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("hi").agg(F.min("lo").alias("m")).withColumnRenamed("hi", "w")
    moved = links.join(least, links["hi"] == least["w"]).where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select(F.col("w").alias("hi"), F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Node and component (the smallest node reachable) of every node of `edges`, columns a
    and b, in any direction, repeated or not. Nodes without an edge to another have no row.

    Each round is written to the shared folder, so a lost executor costs no earlier round.
    The links only ever get fewer or move to smaller nodes; when a round changes nothing, all
    are stars around the smallest node. The fingerprint of a round is one row.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    links, seen = materialize(links, "links"), None
    while True:
        sums = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if seen == tuple(sums) or sums[0] == 0:
            break
        seen = tuple(sums)
        links = materialize(_small_star(_large_star(links)), "links")
    nodes = links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct())
