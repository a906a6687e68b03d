"""Connected components of an edge table, by star contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.shared import stash


def _hang(edges: DataFrame, up: bool) -> DataFrame:
    """Each node's neighbours hang on the smallest node around it: neighbours above the node (up) or those below it
    with the node itself."""
    if up:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select("u", F.least("u", "low").alias("low"))
    if up:
        hung = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        hung = both.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        hung = hung.unionByName(least.select("u", F.col("low").alias("v")))
    return hung.where("u != v").distinct()


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node hangs on two nodes, or on one that hangs itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    told = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return not told.where("hangs > 1 or (hangs = 1 and holds = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (u, v): component is the smallest node that it reaches. Nodes
    without an edge are not listed. Every round writes its edges to the shared folder; the last leaves stars, whose
    centres are smaller than what hangs on them."""
    now = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stash(now, "edges")
    while _unfinished(now):
        now = stash(_hang(_hang(now, up=True), up=False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
