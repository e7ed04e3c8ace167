"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.toDF("u", "v"))


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the links: equal once a round changes nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v: long) -> (node, component): each linked node with the smallest node that it reaches.

    Rounds go on until one changes nothing: their number grows with the logarithm of the nodes.
    Only minima are gathered per node, so a node with any number of links is no bottleneck.
    Nodes without links aren't returned.
    """
    edges = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before, state = None, _state(edges)
    while state[0] and state != before:
        edges = materialize(_small(_large(edges).where("u <> v").distinct()).where("u <> v").distinct(), "links")
        before, state = state, _state(edges)
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
