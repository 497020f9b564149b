"""Aggregate expressions shared by the facts.

Measured quantities (downtime hours, costs) are short decimals stored as
doubles.  Summing doubles gives a result that depends on the order partial
sums are merged in, i.e. on partitioning and AQE decisions, so two runs of the
same job can differ in the last bits.  ``exact_sum`` accumulates in a decimal
(exact and order-independent to 9 decimals) and converts once at the end.  Values no
decimal holds (infinite, or 1e15 and more) are added as doubles beside it, so they show
in the sum; NaN counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accumulator type for measured quantities (up to MOST in size): 9 decimals.
EXACT = "decimal(38,9)"
MOST = 1e15


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact_sum(x) -> Column:
    """Order-independent sum; null for an empty/all-null group."""
    v = F.nanvl(_c(x).cast("double"), F.lit(None).cast("double"))
    small = F.abs(v) < MOST
    fine = F.sum(F.when(small, v).cast(EXACT)).cast("double")
    rest = F.sum(F.when(~small, v))
    return F.coalesce(fine + rest, fine, rest)


def exact_sum0(x) -> Column:
    """Order-independent sum with 0 for an empty/all-null group (the pandas convention)."""
    return F.coalesce(exact_sum(x), F.lit(0.0))


def exact_avg(x) -> Column:
    return F.try_divide(exact_sum(x), F.count(_c(x)))


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")
