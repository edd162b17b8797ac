"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gigloom.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of `links` (u, v long): the smallest node reachable, itself included.

    A node's neighbours are only ever reduced to their minimum before the shuffle and joined
    back, never gathered, so a hub of any size is split by adaptive skew handling. Each round
    is a table in the shared folder. No links give no rows; loops and repeats change nothing.
    """
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    nodes = links.selectExpr("explode(array(u, v)) AS node").distinct()
    seen = None
    if edges.isEmpty():
        return nodes.withColumn("component", F.col("node"))
    again = F.bitwise_not(F.bitwise_not("u")).alias("u")  # computed anew: the join shuffles this side too, so a hub on the other can be split
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least.select(again, "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.select(again, "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).where("u <> v")
        edges = stored(small.distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    root = edges.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(root, nodes.node == root.u, "left").select("node", F.coalesce("component", "node").alias("component"))
