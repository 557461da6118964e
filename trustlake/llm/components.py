"""Connected components of an edge table, by alternating star operations on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.common import written


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """node, root: the least node of each node's component; nodes without edges are absent.

    Each round, every node's larger neighbours and then its smaller ones are linked to the least neighbour, until the
    edges stay the same; the number of rounds grows with the logarithm of the longest path. A node with very many
    neighbours is met by an aggregate and a join, which can be split, and never gathered.
    """
    pairs = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct()
    pairs, before = written(pairs, "edges"), None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low.select("u", F.col("m").alias("v"))).distinct()
        pairs = written(small, "edges")
        # Two sums of 64-bit hashes, in full, tell one set of edges from another.
        now = pairs.agg(F.count("*"), *[F.sum(F.xxhash64(F.lit(i), "u", "v").cast("decimal(20,0)")) for i in (1, 2)]).first()
        if now == before:
            break
        before = now
    roots = pairs.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
