"""Connected components by contraction, wholly distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; component is the least node reachable.

    Nodes are ordered by a hash of their ids, so that no order of ids makes long
    chains. Each round sends every node to the least, in that order, of itself
    and its neighbours, then on to where that one is sent, and replaces edges by
    those between the nodes sent to, which leaves about a third of a chain's
    nodes and one of a star's; the rounds are logarithmic. At the end each component is named by its least id. Edges
    and labels are written to the shared folder each round. Self-loops, repeated
    edges and either direction are allowed; rows with a null are left out; an
    empty input gives an empty result.
    """
    e = scratch.keep(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null and a <> b").distinct())
    labels = None
    rank = lambda c: F.struct(F.xxhash64(F.col(c)).alias("order"), F.col(c).alias("node"))
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(F.col("a").alias("at")).agg(F.min(rank("b")).alias("near"))
        to = scratch.keep(to.select("at", F.least(rank("at"), "near")["node"].alias("to")))
        to = scratch.keep(to.join(to.toDF("to", "further"), "to").select("at", F.col("further").alias("to")))
        if labels is None:
            labels = to.select(F.col("at").alias("node"), F.col("to").alias("root"))
        else:
            labels = labels.join(to, labels["root"] == to["at"], "left").select("node", F.coalesce("to", "root").alias("root"))
        labels = scratch.keep(labels)
        e = e.join(to.toDF("a", "a2"), "a").join(to.toDF("b", "b2"), "b").where("a2 <> b2")
        e = scratch.keep(e.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct())
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    least = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(least, "root").select("node", "component")
