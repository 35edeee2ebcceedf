"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lucrum.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: every node's neighbours are tied to its least neighbour (the
    larger ones, or the smaller ones and itself)."""
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.where("b > a").join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        near = down.groupBy("a").agg(F.min("b").alias("m"))
        out = (down.join(near, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionAll(near.select("a", F.col("m").alias("b"))))
    return out.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b long) the least node it
    is connected with. Nodes without edges don't occur. Rounds go on until the
    edges no longer change; the number of rounds grows with the logarithm of
    the longest path, not with its length."""
    spark = edges.sparkSession
    now = stored(spark, edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == mark or not sums[0]:
            break
        mark = sums
        now = stored(spark, _star(_star(now, large=True), large=False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
