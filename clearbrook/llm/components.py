"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbrook.llm.common import discard, keep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: all larger ones (large), or the smaller ones and the node itself (small).

    The smallest neighbour is an aggregate and is joined back, so that a node with very many neighbours never has to
    be gathered; the join can split it.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    hung = both.join(least, "u")
    if large:
        hung = hung.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        hung = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return hung.where(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node of ``edges`` (u, v: bigint) that is not the smallest of its component.

    Rounds grow with the logarithm of the number of nodes, also on chains. Each round is a table in the shared folder,
    the one before it is removed.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") > F.col("v")).distinct()
    edges, mark = keep(edges, "edges"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or not now[0]:
            return edges.select("u", F.col("v").alias("root"))
        mark = tuple(now)
        nearer = keep(_star(_star(edges, large=True), large=False), "edges")
        discard(edges)
        edges = nearer
