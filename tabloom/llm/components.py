"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: u, v. Returns node, component (the smallest node reachable), for nodes with
    an edge to another node. Rounds grow with the logarithm of the longest path; each is a
    table in the shared folder, so a lost executor costs one round at most.
    """
    current = stored(edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "edges")
    total = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
    while total[0]:
        # Large star: larger neighbours move to the smallest neighbour.
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")
        # Small star: smaller neighbours and the node itself move to the smallest neighbour.
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        current = stored(small.where("u <> v").distinct(), "edges")
        now = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if now == total:
            break
        total = now
    return current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
