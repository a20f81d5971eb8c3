"""Connected components of links by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphshed.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connect(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the links (u, v) the smallest node it is connected with.

    The large-star step links every larger neighbour of a node to the smallest
    one it knows, the small-star step the node and its smaller neighbours;
    both leave the components as they are and end in stars after about
    log(n)**2 rounds. Minima are summed before the shuffle, and the joins can
    split the rows of a node with many neighbours.
    """
    links = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large)
        # Now v < u in every link: the smallest smaller neighbour of each node.
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        links = cut(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())
