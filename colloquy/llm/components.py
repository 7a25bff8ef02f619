"""Connected components of a table of links, by contraction in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import Stored

C = F.col


def connected(spark: SparkSession, links: DataFrame, store: Stored) -> DataFrame:
    """``node, head``: equal heads for the nodes that the links ``a, b`` connect.

    Each round maps every node to the one of lowest hash among itself and its
    neighbours, and links the images. Hashes are in random order, so the nodes
    that still have a link become fewer by a constant factor a round, whatever
    the shape of the graph. Minima are combined before the shuffle; a node with
    many neighbours is a skewed key of equi-joins, which adaptive execution
    splits. Every round is a written table.
    """
    edges = store.put(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    heads = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(C("b").alias("a"), C("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), C(c).alias("v"))
        nearest = both.groupBy("a").agg(F.min(rank("b")).alias("near"))
        hooks = store.put(nearest.select("a", F.least(rank("a"), C("near"))["v"].alias("to")))
        on = lambda c: hooks.select(C("a").alias(c), C("to").alias(f"{c}_to"))
        moved = edges.join(on("a"), "a").join(on("b"), "b").where("a_to <> b_to")
        narrowed = store.put(
            moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct()
        )
        if heads is None:
            after = store.put(hooks.select(C("a").alias("node"), C("to").alias("head")))
        else:
            step = hooks.select(C("a").alias("head"), "to")
            after = store.put(heads.join(step, "head", "left").select("node", F.coalesce("to", "head").alias("head")))
            store.drop(heads)
        store.drop(edges, hooks)
        edges, heads = narrowed, after
    if heads is None:
        heads = edges.select(C("a").alias("node"), C("b").alias("head"))
    return heads
