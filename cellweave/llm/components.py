"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.batches import stored


def _lowest(near: DataFrame) -> DataFrame:
    return near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _is_done(links: DataFrame) -> bool:
    """Whether every node has one link, and that to a node without."""
    sides = links.select(F.col("u").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("downs"))
    )
    seen = sides.groupBy("node").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return seen.filter((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("downs") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in ``links`` (u, v); a component is named after its
    smallest node. Direction, repetition and loops do not matter.

    Each round links neighbours above a node, and then those below it, to the lowest
    neighbour. Rounds are logarithmic in practice. Every round is a few joins of links, its
    result is written to the shared folder, and nothing of it comes to the driver. The lowest
    neighbour is found by partial aggregation and stored, so that the links it is joined to are
    one of two plain exchanges, and those of a node with very many neighbours can be split.
    """
    low, high = F.least("u", "v"), F.greatest("u", "v")
    # From here on u is above v.
    links = stored(links.select(high.alias("u"), low.alias("v")).filter("u <> v").distinct())
    while not _is_done(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        upper = both.join(stored(_lowest(both)), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        upper = upper.filter("u <> v")
        upper = stored(upper)
        lowest = stored(_lowest(upper))
        lower = upper.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(lower.unionByName(lowest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
