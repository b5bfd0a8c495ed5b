"""Connected components of a graph whose edges are rows of a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulselake.llm.common import stored


def stars(edges: DataFrame) -> DataFrame:
    """``u`` and ``v``, the smallest node reachable, for edges (``a``, ``b``) of longs; without the smallest nodes.

    Alternates large-star and small-star steps until the graph is a set of
    stars. An exchange holds two rows of two numbers for an edge at most. The
    smallest neighbour of a node is a partial aggregate; the edges of one node
    meet in one task, where Spark sorts them. Both steps together are four
    exchanges, and a graph that is a set of stars already gets none.
    """
    up, low = F.greatest("a", "b"), F.least("a", "b")
    now = stored(edges.where("a <> b").select(up.alias("u"), low.alias("v")).distinct(), "components")
    while not _are_stars(now):
        # Large star: each neighbour above a node goes to the smallest neighbour of that node, or to the node.
        least = now.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = now.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v"))
        # Small star: each neighbour below a node, and the node, go to the smallest of them.
        small = large.withColumn("m", F.min("v").over(W.partitionBy("u")))
        ends = F.explode(F.array("u", "v")).alias("u")
        now = stored(small.select(ends, F.col("m").alias("v")).where("u <> v").distinct(), "components")
    return now


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for edges (``a``, ``b``) of longs.

    Nodes without an edge to another node are not returned: each is its own label.
    """
    now = stars(edges)
    labelled = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labelled.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def grown_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The components of a graph with ``labels`` after it got further edges (``a``, ``b``).

    Only the components that the edges join are looked at, as one node each.
    """
    joined = stars(apart(edges, labels, "a", "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
    if joined.isEmpty():
        return labels
    to = joined.select(F.col("u").alias("label"), F.col("v").alias("to"))
    old = labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    # Nodes that had no edge before come from the new stars.
    up, low = joined.select(F.col("u").alias("node"), "v"), joined.select(F.col("v").alias("node"), "v")
    new = up.unionByName(low).withColumnRenamed("v", "label")
    return stored(old.unionByName(new).distinct(), "components-grown")


def apart(pairs: DataFrame, labels: DataFrame, a: str, b: str) -> DataFrame:
    """The pairs whose ends lie in different components, with these as ``la`` and ``lb``."""
    ends = labels.select(F.col("node").alias(a), F.col("label").alias("la"))
    others = labels.select(F.col("node").alias(b), F.col("label").alias("lb"))
    named = pairs.join(ends, a, "left").join(others, b, "left")
    named = named.select(a, b, F.coalesce("la", a).alias("la"), F.coalesce("lb", b).alias("lb"))
    return named.where("la <> lb")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each upper node has one edge and is no lower node."""
    up, low = F.col("u").alias("node"), F.col("v").alias("node")
    ends = edges.select(up, F.lit(1).alias("up"), F.lit(0).alias("low"))
    ends = ends.unionByName(edges.select(low, F.lit(0).alias("up"), F.lit(1).alias("low")))
    by_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
    return by_node.where("up > 1 or (up = 1 and low = 1)").isEmpty()
