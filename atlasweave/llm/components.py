"""Connected components over an edge table, without the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node of ``edges`` (``a``, ``b`` long).

    Alternates large-star and small-star steps (Kiveris and others, 2014): every
    round rewires each node's links to the smallest neighbour, so the edge table
    never grows and becomes one star per component after few rounds.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = scratch.write(pairs, "edges")
    for _ in range(max_rounds):
        if _all_stars(now):
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.write(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(now)
        now = after
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has links to one smaller node (``v``) only, which has none to a smaller one itself."""
    up, down = F.lit(1).alias("up"), F.lit(0).alias("down")
    ends = edges.select(F.col("u").alias("node"), up, down).union(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 or up > 0 and down > 0").isEmpty()
