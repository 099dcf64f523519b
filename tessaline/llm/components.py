"""Connected components of an edge table, without any vertex's edges meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def is_star_forest(edges: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u."""
    if not edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
        return False
    return edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node that isn't the smallest of its component: label is that smallest node.

    Alternating large-star and small-star steps: each replaces a vertex's edges by edges to the least of its neighbours. A
    vertex's minimum is a partial aggregate and is joined back, so that a vertex with very many edges is split like any
    skewed join key. The number of rounds grows with the logarithm of the longest chain. Null ends and loops are ignored;
    repeated edges count once; no edges give no rows.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where((F.col(a) != F.col(b))).distinct()
    now = materialise(now, "edges")
    while not is_star_forest(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
