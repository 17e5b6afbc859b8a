"""Connected components by alternating large-star and small-star over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.session import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large-star links every larger neighbour to the least of a node's neighbourhood, small-star every smaller one.

    The least comes from partial minima, so a node with very many neighbours meets in no task; the join back is
    one that Spark may split.
    """
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def _is_settled(links: DataFrame) -> bool:
    """Whether the links are stars already: every node points to one other, which points to none."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(
        links.select(F.col("v").alias("x"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    each = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return each.where("out > 1 or (out > 0 and in > 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns u, v); a component is named after its least node.

    Loops and repeated links do no harm; no links give no rows. The driver sees one yes or no a round.
    """
    links = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _is_settled(links):
        links = stored(_star(_star(links, large=True), large=False), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
