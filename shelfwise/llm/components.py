"""Connected components of links, by alternating star contraction on DataFrames.

Each round hooks every node's larger neighbours to its smallest neighbour, then
its smaller ones; rounds end when only stars are left, after about the logarithm
of the longest chain. Minima are partial sums before the shuffle, and
every join reads both sides from tables, so a node with very many links is
split by the adaptive skew join. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.shared import stored


def _stars(links: DataFrame) -> bool:
    """Whether every node has one parent and no parent has one itself."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")).union(
        links.select("v", F.lit(0), F.lit(1)))
    wrong = ends.groupBy("x").agg(F.sum("child").alias("c"), F.max("parent").alias("p")).where(
        "c > 1 or (c > 0 and p > 0)")
    return wrong.isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of all nodes that have a link; the component is its smallest node."""
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = stored(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _stars(links):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                       .select("u", F.least("u", "m").alias("m")), "least")
        links = stored(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "links")
        least = stored(links.groupBy("u").agg(F.min("v").alias("m")), "least")
        hooked = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(hooked.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select("v", "v").distinct())
