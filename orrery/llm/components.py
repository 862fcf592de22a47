"""Connected components of a table of links, by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import tidy, written


def _stars(edges: DataFrame) -> bool:
    """Whether every node points at one node, and those at none: then these are the roots."""
    points = edges.unionAll(edges.select(F.col("v").alias("u"), "v"))
    with tidy(edges.sparkSession):
        return points.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high")).filter("low <> high").isEmpty()


def connected(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) of every node of the links; root is the least node of its component.

    Every round points each node's larger neighbours at its least neighbour (large star),
    then its smaller neighbours and itself at the least of them (small star), until every
    component is a star: about log(n) rounds. Least neighbours are aggregates joined back, so
    the neighbours of a node are never gathered in one place, and a node with very many is
    a skewed join key that can be split.
    """
    edges = written(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter("u <> v").distinct(), "links")
    while not _stars(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = written(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionAll(edges.select(F.col("u").alias("node"), F.col("v").alias("root")))
