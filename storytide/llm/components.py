"""Connected components of a graph given by its edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storytide.llm.runtime import stored

MAX_ROUNDS = 60


def _hook(edges: DataFrame, only_larger: bool) -> DataFrame:
    """Neighbours of each node ``u`` attached to the smallest of them and itself.

    ``only_larger`` (large star): of all neighbours the larger ones; otherwise (small star) the
    smaller ones and the node itself. The minimum is a partial aggregate, and the join with it
    may be split by adaptive execution, so a node with very many edges does no harm.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not only_larger:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if only_larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node that each node of ``edges`` (``u, v``) can reach.

    Nodes without an edge to another node are left out. Each round is stored, so the plan
    stays short and a lost executor costs one round; the edges end as stars around the minima.
    """
    now = stored(edges.where("u != v").select("u", "v").distinct(), "edges")
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).cast("decimal(38,0)")
    last = None
    for _ in range(MAX_ROUNDS):
        now = stored(_hook(_hook(now, only_larger=True), only_larger=False), "stars")
        seen = now.agg(F.count("*"), mark).first()
        if seen == last:
            break
        last = seen
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
