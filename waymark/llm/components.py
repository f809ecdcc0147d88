"""Connected components by distributed union-find, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import forget, materialise


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, root)`` for every node of an edge list; ``root`` is the smallest node of its component.

    Rounds of two contractions until every component is a star: each node hands its larger neighbours (large star), then
    its smaller ones (small star), to the smallest node it knows. Edges only ever move towards the smallest node, so
    that takes about log(nodes) rounds. Each round is one table in the shared folder, which cuts lineage. A star's centre
    can have very many edges: the minimum of a node is a partial aggregate, and the join that hands it out is an inner
    equi-join, whose large partitions AQE splits. Loops and repeated edges don't matter; edges with a null end are left
    out. An empty edge list gives an empty result.
    """
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    pairs = materialise(pairs.filter("u != v").distinct(), "edges")
    while not _stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v"))
        small = small.filter("u != v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        known, pairs = pairs, materialise(small, "edges")
        forget(known)
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(pairs: DataFrame) -> bool:
    """Whether every larger end is one of one edge, and no smaller end: then the smaller ends are the roots."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(pairs.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    of = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return of.filter("ups > 1 or (ups = 1 and least = 0)").isEmpty()
