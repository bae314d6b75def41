"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import drop, stage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, folder: str) -> DataFrame:
    """Links ``(a, b)`` of longs to ``(node, root)``, root the smallest node reachable; roots themselves have no row.

    Each round hangs every neighbour below the smallest neighbour seen; rounds grow with the logarithm of the largest
    component. Minima are taken by partial aggregation, so a node with very many links is reduced before its shuffle,
    and the joins that follow are plain inner joins, which adaptive execution splits where a node is hot. Rounds are
    written to ``folder``. No links give no rows.
    """
    spark = links.sparkSession
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  folder, "edges0")
    before, n = _mark(edges), 0
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(below, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        )).alias("e")).select("e.a", "e.b").where("a <> b").distinct())
        edges, n = stage(small, folder, f"edges{n + 1}"), n + 1
        after = _mark(edges)
        drop(spark, folder, f"edges{n - 1}")
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
