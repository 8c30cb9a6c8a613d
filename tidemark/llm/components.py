"""Connected components of a graph whose nodes are longs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is tied to the node's smallest neighbour, or to itself."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them; edges go from u down to v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.toDF("u", "v"))


def _shape(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def roots(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node with an edge reaches, itself included.

    ``edges``: (u, v), in any direction, repeated or not. Each round is written to the shared folder;
    only a count and a checksum of the edges come to the driver, to tell when nothing moves any more.
    """
    down = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    down = stored(down.distinct(), "edges")
    shape = _shape(down)
    while shape[0]:
        down = stored(_small_star(_large_star(down).distinct()).distinct(), "edges")
        if shape == (shape := _shape(down)):
            break
    return down.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        down.select(F.col("v"), F.col("v")).distinct()
    )
