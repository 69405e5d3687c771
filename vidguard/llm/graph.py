"""Connected components of an edge table, by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step. Edges (u, v), v < u. The minimum per node is combined before the shuffle."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
        if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links -> (node, component): the smallest node reachable, for every node with a link.

    Nulls and loops are ignored. Each round is written to the shared folder, so lineage stays short
    and a lost executor costs a re-read. Rounds grow with the logarithm of the longest chain.
    """
    now = written(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = mark
        now = written(_star(_star(now, large=True), large=False))
