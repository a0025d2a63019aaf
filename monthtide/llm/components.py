"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthtide.llm.frames import settle


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node that each node of ``links`` (a, b) reaches.

    Rounds of large stars and small stars: every node hands its smallest neighbour on, first
    to the larger ones and then to the smaller ones, until each component is one star. A
    round is joins and minima that combine before the shuffle, so a node with very many
    neighbours is no hot spot, and its table in the shared folder cuts the lineage. The
    number of rounds grows with the logarithm of the longest path.
    """
    edges = settle(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        after = tuple(mark.first())
        if after == before or not after[0]:
            break
        before = after
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), "m")
        large = large.where("u <> m").distinct()
        below = large.groupBy("u").agg(F.min("m").alias("least"))
        small = large.join(below, "u")
        small = small.select(F.col("m").alias("u"), F.col("least").alias("v")).union(
            below.select("u", F.col("least").alias("v"))
        )
        edges = settle(small.where("u <> v").distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
