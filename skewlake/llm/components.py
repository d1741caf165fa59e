"""Connected components of links, by contraction over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored


def _rank(node: str) -> Column:
    """Order of nodes that has nothing to do with how they are linked, so that chains fold in few rounds."""
    return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("v"))


def components(links: DataFrame) -> DataFrame:
    """links: a, b long. Returns node, part for every node named in a link; part is the smallest node it can reach.

    In each round every node goes over to the first of itself and its neighbours, twice, and links between what is
    then one are dropped: a star is done in two rounds, and links get fewer with every round.
    """
    edges = stored(links.filter("a <> b").select("a", "b").union(links.filter("a <> b").select(F.col("b"), F.col("a"))).distinct())
    label: DataFrame | None = None
    while True:
        near = stored(edges.groupBy("a").agg(F.min(_rank("b")).alias("first")).select("a", F.least("first", _rank("a"))["v"].alias("up")))
        up = stored(near.join(near.toDF("up", "top"), "up").select("a", F.col("top").alias("up")))
        if label is None:
            label = up.toDF("node", "part")
        else:
            label = stored(label.join(up.toDF("part", "top"), "part", "left").select("node", F.coalesce("top", "part").alias("part")))
        edges = edges.join(up.toDF("a", "x"), "a").join(up.toDF("b", "y"), "b").filter("x <> y")
        edges = stored(edges.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        if edges.isEmpty():
            break
    low = label.groupBy("part").agg(F.min("node").alias("low"))
    return label.join(low, "part").select("node", F.col("low").alias("part"))


def stars(postings: DataFrame) -> DataFrame:
    """postings: node, key. Links each node to the smallest node of each of its keys; equal components, few rows."""
    low = postings.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high").select("key", "low")
    return postings.join(low, "key").filter("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
