"""Connected components of a large graph, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import stage


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Link neighbours to the least of them: larger ones, or (small) lesser ones and the node."""
    both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if not small:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("m"))
    near = both.join(least, both["u"] == least["node"])
    if small:
        linked = near.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    else:
        linked = near.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.where("a != b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge to another one; edges have
    columns a and b, component is the least node.  Repeated edges, loops and both
    directions are welcome; no edges give no rows."""
    now = stage(edges.select("a", "b").where("a != b").distinct(), "edges")
    seen = None
    while seen != (mark := _mark(now)) and mark[0]:
        seen = mark
        now = stage(_stars(_stars(now, small=False), small=True), "stars")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
