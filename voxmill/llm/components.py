"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.sources.staging import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node of its component, for every node of ``links``.

    Each round keeps as many rows as nodes plus links at most; minima are summed up per task
    first, and joins on a node with many links are left to adaptive skew handling. Rounds grow with the
    logarithm of the longest chain. Every round is a stage table, so nothing is recomputed.
    """
    edges = stage(
        links.where(F.col(a) != F.col(b)).select(
            F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
        ).distinct(),
        "links",
    )
    while True:
        # Large star: neighbours above a node move to the smallest of its neighbourhood.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u")
            .where("w != m").select(F.col("w").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(moved.union(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        if _same(edges, after):
            break
        edges = after
    return after.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _same(before: DataFrame, after: DataFrame) -> bool:
    sums = [
        df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first() for df in (before, after)
    ]
    return sums[0] == sums[1]
