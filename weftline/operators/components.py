"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether each left end has one edge and no node is both a left and a right end."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("left"), F.lit(0).alias("right")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("left"), F.lit(1).alias("right"))
    )
    bad = ends.groupBy("n").agg(F.sum("left").alias("l"), F.sum("right").alias("r")).filter((F.col("l") > 1) | ((F.col("l") > 0) & (F.col("r") > 0)))
    return bad.isEmpty()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for each node of ``edges``; the component is its smallest node.

    Minima are aggregated on the map side and joined back, so a hub with a large
    share of all edges is never gathered in one task. Each round is written to
    the shared folder. Loops and nulls are ignored; nodes without an edge to
    another node are not returned.
    """
    pairs = edges.select(F.col(u).alias("a"), F.col(v).alias("b")).filter(F.col("a") != F.col("b"))
    now = written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    for _ in range(max_rounds):
        if _is_star_forest(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        both = now.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(now.select(F.col("v").alias("a"), F.col("u").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "cc")
    raise RuntimeError(f"no star forest after {max_rounds} rounds")
