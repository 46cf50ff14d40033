"""Connected components of an edge table, on Spark: alternating large-star and
small-star steps until the edges are stars around each component's smallest
node.  Minima are partial aggregates and joins are plain equi-joins, so a node
with very many edges is neither collected nor enumerated in pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import Workspace


def _step(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    return (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame, ws: Workspace, name: str) -> DataFrame:
    """``node``, ``comp`` (smallest node reachable) for every node that has an
    edge and is not itself the smallest.  ``edges``: u, v (u <> v)."""
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    seen, k = None, 0
    while True:
        e = ws.write(e if k == 0 else _step(e), f"{name}-{k}")
        if k:
            ws.drop(f"{name}-{k - 1}")
        sign = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if sign == seen or not sign[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        seen, k = sign, k + 1
