"""Connected components of an edge table, by alternating star contractions.

Each round rewires every edge towards the smallest known neighbour with two
grouped minima and two joins; hub nodes are never gathered into one task
(minima combine map-side, the joins are plain shuffle joins that the
adaptive planner can split).  The edge table of every round is written to
the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wingspan.llm.common import stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One large-star (or small-star) contraction of directed rows (u, v).

    ``pairs`` holds the neighbours v of each centre u that take part; with
    m = min(u, its v), every v above u (large) or every v and u itself
    (small) is linked to m.
    """
    low = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    wired = pairs.join(low, "u")
    if large:
        return wired.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (wired.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).filter("u > v"))


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for every node of ``edges``; root is the smallest node reachable.

    Self loops only name their node.  Nodes are of an ordered type without
    nulls; rows with a null end are ignored.  Raises when the contraction
    has not settled after ``max_rounds`` (the rounds grow with the logarithm
    of the longest path).
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    nodes = e.select(F.col("x").alias("node")).union(e.select(F.col("y").alias("node"))).distinct()
    now = stored(e.filter("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"))
                 .distinct(), "cc-edges")
    sign = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        grown = _star(both, large=True).filter("u > v").distinct()
        now = stored(_star(grown, large=False).distinct(), "cc-edges")
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == tuple(got):
            break
        sign = tuple(got)
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    roots = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
