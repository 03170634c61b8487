"""Connected components of a graph of edges, by alternating stars.

Large star: every node links its larger neighbours to its least neighbour.
Small star: every node links its smaller neighbours and itself to the least.
Both are an aggregation (combined map-side, so a node with very many edges
costs one row a task) and a join that Spark can split; the forest settles
after a few rounds.  Each round is checkpointed in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v); a node's own place counts as a neighbour."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        out = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v: long) that isn't its component's least; root is that least node."""
    now, before = edges.select("u", "v").where("u <> v").distinct().checkpoint(), None
    while True:
        now = _star(_star(now, True), False).checkpoint()
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            return now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
        before = state
