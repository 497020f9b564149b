"""Connected components of an edge table by alternating large and small stars.

Every round each node hands its greater neighbours, then its smaller ones, to the
smallest node it knows, until each component is a star around its smallest node; the
number of rounds grows with the logarithm of the component's size.  Each round is a
written table, so lineage stays short and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolwatch.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(mark, 20)), F.bit_xor(mark)).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (a, b): the smallest id it is connected with.

    Loops, repeated edges and edges in either direction are fine; an edge with a null
    end is left out.  No edges give no rows.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = written(pairs, "edges")
    before = _state(stars)
    while before[0]:
        stars = written(_small_star(written(_large_star(stars), "large-star")), "small-star")
        after = _state(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
