"""Connected components of a graph given as edges, by alternating star contraction.

Large and small stars (Kiveris and others): every node's neighbours are hung on the
smallest of them until only stars are left. Each step is one aggregation and one join
over the edges and is written, so a lost executor costs one step; the number of steps
grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _hung(edges: DataFrame) -> DataFrame:
    """One round on edges ``(u, v)`` with ``u > v``: large star, then small star."""
    both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
    smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # Large star: neighbours above u move to the smallest neighbour of u.
    large = (
        both.filter("v > u").join(smallest, "u").selectExpr("v AS u", "m AS v").filter("u > v").distinct()
    )
    large = written(large, "large-star")
    # Small star: u and its smaller neighbours move to the smallest of them.
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    return (
        large.join(least, "u").selectExpr("v AS u", "m AS v").filter("u > v")
        .unionByName(least.selectExpr("u", "m AS v")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(hashed.cast("decimal(20,0)"))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Columns ``node`` and ``root``, the smallest node reachable, of all nodes with an edge."""
    now = written(
        edges.selectExpr(f"greatest({left}, {right}) AS u", f"least({left}, {right}) AS v")
        .filter("u > v").distinct(), "edges",
    )
    state = _state(now)
    while state[0]:
        after = written(_hung(now), "stars")
        known, state = state, _state(after)
        now = after
        if state == known:
            break
    return now.selectExpr("u AS node", "v AS root").unionByName(
        now.selectExpr("v AS node", "v AS root").distinct()
    )
