"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node that edges (u, v) of longs reach, for every node with an edge.

    Each round is a few joins and sums over the edges, written to the shared folder; rounds grow with the logarithm of
    the components' size. A star is already a fixed point, so a hot centre costs one row per edge.
    """
    e = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), label)
    print_of = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
    seen = print_of(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(m.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        last, e = e, staged(small, label)
        discard(last)
        now = print_of(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
