"""The three marts over canonical trips. None sorts its result; callers do at the edge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.quantiles import quantile, with_cumulative_counts
from kerbside.functions.trips import usable
from kerbside.settings import LONG_TRIP_SECONDS


_SORT_KEYS = ("service_type", "year", "month", "zone_id", "ts_hour", "hour")


def ordered(mart: DataFrame) -> DataFrame:
    """The mart sorted by its keys, for showing it; later jobs need no order."""
    return mart.orderBy(*[key for key in _SORT_KEYS if key in mart.columns])


def _mean(total: str, count: str) -> Column:
    return F.sum(total) / F.nullif(F.sum(count), F.lit(0))


def demand_counts(trips: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Usable trips, fares and distances per service, zone, hour and duration."""
    return (
        trips.filter(usable())
        .groupBy(
            "service_type",
            F.col("pu_location_id").alias("zone_id"),
            F.date_trunc("hour", "pickup_datetime").alias("ts_hour"),
            "trip_duration_sec",
            *more,
        )
        .agg(
            F.count("*").alias("n"),
            F.sum("total_amount").alias("amount"),
            F.count("total_amount").alias("amount_n"),
            F.sum("trip_distance").alias("distance"),
            F.count("trip_distance").alias("distance_n"),
        )
    )


def demand_from_counts(counts: DataFrame) -> DataFrame:
    """The demand mart from one row per service, zone, hour and duration."""
    keys = ["service_type", "zone_id", "ts_hour"]
    return (
        with_cumulative_counts(counts, keys, "trip_duration_sec", "n")
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("pickups"),
            _mean("amount", "amount_n").alias("avg_total_amount"),
            _mean("distance", "distance_n").alias("avg_trip_distance"),
            quantile("trip_duration_sec", "0.5").alias("p50_duration"),
            quantile("trip_duration_sec", "0.95").alias("p95_duration"),
        )
    )


def zone_hour_demand(trips: DataFrame) -> DataFrame:
    """Pickups, mean fare and distance, median and p95 duration per service, zone and hour."""
    return demand_from_counts(demand_counts(trips))


def monthly_service_summary(trips: DataFrame) -> DataFrame:
    """Trips, pickup zones, mean and p95 duration per service and month.

    Few and very large groups: one pass counts durations and zones side by side
    (grouping sets), so each task sends at most a histogram and a zone list.
    """
    keys = ["service_type", "year", "month"]
    sides = (
        trips.filter("valid_time")
        .groupingSets(
            [
                [*keys, "trip_duration_sec"],
                [*keys, "pu_location_id"],
            ],
            *keys,
            "trip_duration_sec",
            "pu_location_id",
        )
        .agg(F.count("*").alias("rows"), F.grouping("pu_location_id").alias("counts_durations"))
        .select(
            *keys,
            "pu_location_id",
            "trip_duration_sec",
            (F.col("rows") * F.col("counts_durations")).alias("n"),
        )
    )
    return durations_summary(sides, keys, F.count("pu_location_id").alias("unique_pu_zones"))


def durations_summary(counts: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Trips, ``more`` aggregates, mean and p95 duration per group, from one row per duration."""
    return (
        with_cumulative_counts(counts, keys, "trip_duration_sec", "n")
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("trips"),
            *more,
            (F.sum(F.col("trip_duration_sec") * F.col("n")) / F.sum("n")).alias("avg_duration_sec"),
            quantile("trip_duration_sec", "0.95").alias("p95_duration_sec"),
        )
    )


def is_long() -> Column:
    return F.col("trip_duration_sec") > LONG_TRIP_SECONDS


def zone_hour_reliability(trips: DataFrame) -> DataFrame:
    """Trip count and share of long trips per service, zone and hour of day."""
    return (
        trips.filter(usable())
        .groupBy("service_type", F.col("pu_location_id").alias("zone_id"), "hour")
        .agg(F.count("*").alias("trip_count"), F.avg(is_long().cast("int")).alias("share_long_trips"))
    )
