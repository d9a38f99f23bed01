"""Connected components of a large graph by alternating stars, each step written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import store


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them. Edges run from larger to smaller nodes."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node that it is connected with, for every node on an edge (columns ``a``, ``b``).

    Large and small stars alternate until nothing changes, after which each edge leads straight to a root; the number of
    rounds grows with the logarithm of the longest chain. A node with very many edges is reduced in the tasks first, and
    its rows are split where it is joined. Loops and repeated edges don't matter.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = store(edges.select(a.alias("a"), b.alias("b")).where("a <> b").distinct(), "edges")
    seen = _sum(now)
    while True:
        now = store(_small_star(_large_star(now)), "edges")
        new = _sum(now)
        if new == seen:
            break
        seen = new
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def labelled(nodes: DataFrame, node: str, member: str, edges: DataFrame) -> DataFrame:
    """``nodes`` (one row per ``node``, with the least ``member`` of it) with ``component_id``, the least member of all
    connected nodes, and ``_root``, the least of these. Rows of ``nodes`` need not be on an edge."""
    roots = connected(edges)
    rooted = nodes.join(roots.withColumnRenamed("node", node), node, "left").withColumn("_root", F.coalesce("root", node)).drop("root")
    least = rooted.groupBy("_root").agg(F.min(member).alias("component_id"))
    return rooted.join(least, "_root")
