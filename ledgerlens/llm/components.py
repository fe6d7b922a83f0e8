"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.storage import stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(u, m): the least of u and its neighbours, for edges in both directions."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least_neighbour(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return down.join(_least_neighbour(down), "u").select(F.explode(F.array("v", "u")).alias("u"), F.col("m").alias("v"))


def _unfinished(edges: DataFrame) -> bool:
    """Whether ``edges`` (distinct, u > v) are not stars yet: a node has two lesser neighbours, or a lesser and a greater one."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("lesser"), F.lit(0).alias("greater")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("lesser"), F.lit(1).alias("greater")))).alias("end")).select("end.*")
    nodes = ends.groupBy("node").agg(F.sum("lesser").alias("lesser"), F.max("greater").alias("greater"))
    return not nodes.where("lesser > 0 and lesser + greater > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node of ``edges`` (u, v: longs) but the least of its component, with that
    least node.  Each step is stored; nothing but the answer whether it was the last reaches the driver.

    Steps keep what is connected.  Once no node has more than one neighbour but those that
    only have greater ones, the edges are one star for each component."""
    edges = edges.where("u <> v")
    while True:
        edges = stored(_small_star(_large_star(edges)).where("u <> v").distinct(), "links")
        if not _unfinished(edges):
            return edges
