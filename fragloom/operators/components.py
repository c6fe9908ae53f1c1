"""Connected components of a link table, without leaving the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fragloom.storage import materialise


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """node, root: for each node of edges (u, v) the least node that it is connected with.

    Alternates two steps until nothing changes: every node hands its greater neighbours to its
    least one, then its smaller neighbours.  What is left are stars around the least nodes.
    Groups are only ever reduced to their minimum, so a node with very many links is no burden
    beyond its rows.  Nodes may be of any type that has an order.  Loops and repeated links do no harm; no links give no rows.
    """
    edges = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Joined on u in a struct, which makes the join shuffle for itself: those shuffles AQE may split where a node
        # has very many links, which it may not do to one that an aggregate below relies on.
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.struct("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").withColumn("k", F.struct("u")).join(least, "k").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v")
        edges = materialise(small.where("u <> v").distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
