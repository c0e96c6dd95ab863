"""Connected components of a graph of links, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, and none of those on another: then those are the smallest of their components."""
    twice = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    inner = edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi")
    return twice.unionByName(inner).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, component for each node of `links` (u, v: bigint): component is the smallest node reachable.

    Each round hangs every node's larger neighbours on its smallest one, then its smaller ones too, until every node hangs on the
    smallest of its component. Rounds are few (they grow with the logarithm of the longest path); each is written to the shared
    folder. A node with very many neighbours is a skewed join, which Spark splits.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = common.stored(ordered, "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")
        edges = common.stored(small.distinct(), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
