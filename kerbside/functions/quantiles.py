"""Exact discrete quantiles from value counts.

A trip duration is a whole number of seconds within four hours, so a group has
at most 14,400 distinct values however many trips it holds. Counting values
first spreads a hot group over its values in the shuffle, merges equal values
on the map side, and leaves only that bounded histogram to order per group.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_REACHED = "__reached"
_TOTAL = "__total"


def with_cumulative_counts(histogram: DataFrame, keys: list[str], value: str, count: str) -> DataFrame:
    """Adds, per row, the group's count up to this value and the group's total.

    Both frames share one ordering, so one window pass yields them.
    """
    ordered = Window.partitionBy(*keys).orderBy(value)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return histogram.select("*", F.sum(count).over(so_far).alias(_REACHED), F.sum(count).over(whole).alias(_TOTAL))


def quantile(value: str, p: str) -> Column:
    """Aggregate: smallest value that at least a share ``p`` of the group does not exceed.

    ``p`` is decimal text, compared in integers, so no rank is lost to rounding.
    """
    share = Fraction(p)
    reached = F.col(_REACHED) * share.denominator >= F.col(_TOTAL) * share.numerator
    return F.min(F.when(reached, F.col(value)))
