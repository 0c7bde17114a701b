"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.llm.chunks import written


def _star(edges: DataFrame, large: bool, label: str) -> DataFrame:
    """Link each node's larger (or, for the small star, its smaller) neighbours to the smallest of node and neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # written, so that both sides of the join are plain shuffles and a hot node's rows can be split
    least = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), f"{label}_least")
    linked = both.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return written(out.where(F.col("a") != F.col("b")).distinct(), label)


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the smallest node it is connected to, for each node of the edges (a, b) but the roots.

    Loops and repeated edges do nothing. No edges give no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b"))
    edges = written(edges.distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if state == before or not state[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        edges = _star(_star(edges, True, "large_star"), False, "small_star")
