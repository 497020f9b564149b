"""Join helpers: calendar-bounded broadcast and scalar (one-row) lookups.

Other joins carry no hint: Spark broadcasts a side by its measured bytes
(``autoBroadcastJoinThreshold``, from file sizes or, under AQE, from the shuffled side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def broadcast_weeks(weeks: DataFrame) -> DataFrame:
    """Broadcast a set of distinct weeks: bounded by the calendar (<= 53 rows per year)."""
    return F.broadcast(weeks)


def scalar(df: DataFrame, expr: Column) -> Column:
    """Scalar subquery: ``expr`` aggregated over ``df`` as a column usable anywhere.

    Spark runs the one-row aggregate as its own job and inlines the value, so no
    join (and no cartesian product) is needed to attach a global statistic.
    Use the returned column once (e.g. attach it with ``withColumn`` and refer
    to that column): every separate use is planned as its own subquery.
    """
    return df.select(expr).scalar()
