"""Connected components of a graph by turns of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import stage


def _hang(edges: DataFrame, node: str, other: str, least) -> DataFrame:
    """Edges (u, v) from each ``other`` to the smallest member of the star of ``node``."""
    roots = edges.groupBy(node).agg(F.min(other).alias("m"))
    return edges.join(roots.select(node, least(F.col("m")).alias("m")), node)


def _turn(edges: DataFrame) -> DataFrame:
    """One large and one small star; ``edges`` holds (u, v) with v < u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _hang(both, "u", "v", lambda m: F.least(m, F.col("u"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u != v").distinct()
    small = _hang(large, "u", "v", lambda m: m)
    own = small.select("u", F.col("m").alias("v"))
    rest = small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.unionByName(rest).distinct()


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """``pairs`` (a, b) of longs to (node, root): the smallest node that each node of a pair is connected with.

    Each turn is written, so a lost executor costs one turn at most; the number of turns grows with the logarithm of the
    number of nodes. No group is gathered in a task: stars are minima and joins, which adaptive execution can split.
    """
    edges = pairs.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stage(edges, "edges")
    for _ in range(rounds):
        # A forest of stars has one parent for each child, and no parent that is a child itself.
        parents = edges.select(F.col("v").alias("u")).distinct()
        n, children, deep = edges.agg(F.count(F.lit(1)), F.countDistinct("u")).first() + (parents.join(edges, "u", "left_semi").count(),)
        if n == children and not deep:
            break
        edges = stage(_turn(edges), "edges")
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
