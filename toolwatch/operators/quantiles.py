"""Exact global median without gathering all values in one task.

Equal values are counted first (partial sums).  The counts are added up in buckets of nearly
equal values, and the bucket that holds a middle rank is divided again, linearly between
its smallest and its greatest value, until it can only hold one value.  However many
values lie close together, a window never sees more than the buckets of one division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets per power of two: values of one bucket differ by 0.14 % at most.
PER_OCTAVE = 512
_SHIFT = 2_000 * PER_OCTAVE


def _bucket(v: Column) -> Column:
    """A number that never falls as the value grows; its range does not depend on the rows."""
    size = F.least(F.abs(v), F.lit(1.7e308))
    place = (F.floor(F.log2(size) * PER_OCTAVE) + _SHIFT).cast("long")
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, place).otherwise(-place)


#: Parts of a bucket, and how often a bucket is divided: a part of the last is finer than any
#: two neighbouring doubles (2**-9 of the value, and 2**-12 of that by every division), also when the first
#: division only parts infinite values from finite ones.
PARTS, DIVISIONS = 4096, 5


def _part(v: Column, low: Column, high: Column) -> Column:
    """The part of [low, high] in which ``v`` lies; never falls as ``v`` grows."""
    share = (v / 2 - low / 2) / (high / 2 - low / 2)  # halves: the width of any two finite values is finite
    inner = F.least(F.floor(F.nanvl(share, F.lit(0.0)) * PARTS), F.lit(PARTS - 1)).cast("long") + 1
    return F.when(v <= low, F.lit(0).cast("long")).when(v >= high, F.lit(PARTS + 1).cast("long")).otherwise(inner)


def _holding(buckets: DataFrame) -> DataFrame:
    """Of the buckets (rank, target, start, b, n, low, high) the one in which each rank's target lies, and what stands before it."""
    order = Window.partitionBy("rank").orderBy("b")
    upto = F.col("start") + F.sum("n").over(order)
    placed = buckets.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("n"))
    return placed.filter((F.col("start") <= F.col("target")) & (F.col("upto") > F.col("target"))).select("rank", "target", "start", "low", "high")


def global_median(df: DataFrame, col: str) -> DataFrame:
    """One row with the exact median of the non-missing values (null if there are none)."""
    v = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    counts = df.select(v.alias("v")).filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    sums = [F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")]
    # At most some thousand buckets for values of any usual spread.
    first = counts.groupBy(_bucket(F.col("v")).alias("b")).agg(*sums)
    first = first.withColumns({"total": F.sum("n").over(Window.partitionBy()), "start": F.lit(0).cast("long")})
    ranks = F.array(F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2))
    at = _holding(first.select("*", F.posexplode(ranks).alias("rank", "target")))
    for _ in range(DIVISIONS):
        # Two rows, one for each middle rank.
        near = counts.join(F.broadcast(at), F.col("v").between(F.col("low"), F.col("high")))
        keys = ["rank", "target", "start"]
        at = _holding(near.groupBy(*keys, _part(F.col("v"), F.col("low"), F.col("high")).alias("b")).agg(*sums))
    # The parts of the last division hold one value each.
    return at.agg((F.sum("low") / F.count("low")).alias("median"))
