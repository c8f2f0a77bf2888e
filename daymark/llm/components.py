"""Connected components of a graph that stays distributed: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the neighbours of each node to the smallest of them and the node.

    edges are (a, b) with a > b. Large stars move the neighbours above a node, small stars the node and
    those below it.
    """
    seen = edges.union(edges.select("b", "a")).toDF("u", "v") if large else edges.toDF("u", "v")
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = seen.join(least, "u")
    if large:
        moved = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("u", "m"))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of edges (a, b): root is the smallest node that links lead to.

    Ends when a round changes nothing, so after about as many rounds as the logarithm of the longest path.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = mark(current)
    while True:
        current = stored(_star(_star(current, True), False), "edges")
        after = mark(current)
        if after == before:
            break
        before = after
    return current.toDF("node", "root").union(current.select("b", "b").distinct().toDF("node", "root"))
