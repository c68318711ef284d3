"""Running totals over all rows without one task for all rows, and rank sums with ties."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.session import Workspace

# Coefficients of the rational approximation of erfc (absolute error 1.5e-7).
_ERFC_P = 0.3275911
_ERFC = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def with_total_before(rows: DataFrame, order: str, count: str, work: Workspace) -> DataFrame:
    """Adds ``before``: the sum of ``count`` over all rows with a smaller ``order``, which no two rows share.

    Rows are dealt by ranges of ``order``. Each range sums its own rows; the ranges'
    totals, one row each, are summed in order and added.
    """
    ranged = work.store(rows.repartitionByRange(order).withColumn("__range", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").agg(F.sum(count).alias("__total"))
    starts = starts.select("__range", F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("__start") + F.coalesce(F.sum(count).over(inside), F.lit(0))
    return ranged.join(starts, "__range").withColumn("before", before).drop("__range", "__start")


def two_sided_p(z: Column) -> Column:
    """Chance of a standard normal value at least as far from zero."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + _ERFC_P * x)
    series = F.lit(0.0)
    for coefficient in reversed(_ERFC):
        series = (series + coefficient) * t
    return series * F.exp(-x * x)


def rank_test(values: DataFrame, group: str, value: str, first: str, second: str, work: Workspace) -> DataFrame:
    """Mann-Whitney test of whether ``first``'s values tend to be larger than ``second``'s; one row.

    n_first, n_second; u: pairs in which ``first`` is larger, ties counting a half;
    superiority: their share; z with correction for ties, and its two-sided p. Equal
    values are counted before they are ranked, so a hot value is one row. Null values
    are left out; z and p are null where either group is empty or all values are equal.
    """
    whole = "decimal(38,0)"
    counts = (
        values.filter(F.col(group).isin(first, second) & F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count_if(F.col(group) == first).alias("a"), F.count("*").alias("n"))
    )
    ranked = with_total_before(counts, value, "n", work)
    a, n = F.col("a").cast(whole), F.col("n").cast(whole)
    sums = ranked.agg(
        F.coalesce(F.sum("a"), F.lit(0)).alias("n_first"),
        F.coalesce(F.sum("n") - F.sum("a"), F.lit(0)).alias("n_second"),
        F.sum(a * (2 * F.col("before").cast(whole) + n + 1)).cast("double").alias("double_ranks"),
        F.sum(n.cast("double") * n * n - n).alias("ties"),
    )
    one, two = F.col("n_first").cast("double"), F.col("n_second").cast("double")
    every = one + two
    spread = one * two / 12 * (every + 1 - F.col("ties") / F.nullif(every * (every - 1), F.lit(0.0)))
    return (
        sums.withColumn("u", F.col("double_ranks") / 2 - one * (one + 1) / 2)
        .withColumn("superiority", F.col("u") / F.nullif(one * two, F.lit(0.0)))
        .withColumn("z", (F.col("u") - one * two / 2) / F.nullif(F.sqrt(spread), F.lit(0.0)))
        .select("n_first", "n_second", "u", "superiority", "z", two_sided_p(F.col("z")).alias("p"))
    )
