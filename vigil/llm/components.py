"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigil.llm.storage import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every greater neighbour is tied to the least of u and its
    neighbours. Small star: u and its lesser neighbours are."""
    near = edges.union(edges.select("v", "u")) if large else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = near.join(least, "u")
    if large:
        tied = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return tied.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """u, root: for every node of an edge (u, v: long) the least node it is
    connected with. Self-loops and repeated edges are allowed; nodes without
    an edge to another node don't appear. Edges stay distributed; every round
    is a written table, and the loop ends when a round changes nothing."""
    now = stored(edges.select("u", "v").where("u <> v").distinct())
    mark = None
    while True:
        sums = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if not sums[0] or sums == mark:
            return now.select("u", F.col("v").alias("root"))
        mark = sums
        now = stored(_star(_star(now, large=True), large=False))
