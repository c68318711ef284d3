"""Questions asked of trips and marts: when, where, how the months move, how airports compare."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.ranks import rank_test
from kerbside.functions.trips import usable, zone_group
from kerbside.session import Workspace
from kerbside.settings import TREND_MIN_TRIPS, ZONE_GROUPS

# Fixed value: fences lie this many quartile distances beyond the quartiles.
FENCE = 1.5
# A value this near to a fence is inside, so that rounding does not decide.
_NEAR = 1e-9


def top_by(df: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """The n rows with the largest measure; ties go to the smaller key."""
    return df.orderBy(F.desc(measure), F.asc(key)).limit(n)


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``members``. A top-n frame tells Spark its size, which picks the join by it."""
    return df.join(members, key, "left_semi").select(df.columns)


def zone_totals(demand: DataFrame) -> DataFrame:
    return demand.groupBy("zone_id").agg(F.sum("pickups").alias("total_pickups"))


def top_zones(demand: DataFrame, n: int) -> DataFrame:
    """The busiest zones over all services and hours."""
    return top_by(zone_totals(demand), "zone_id", "total_pickups", n)


def demand_heatmap(trips: DataFrame, service: str = "yellow") -> DataFrame:
    """Pickups of one service by weekday (1 = Sunday) and hour."""
    return (
        trips.filter((F.col("service_type") == service) & F.col("valid_time"))
        .groupBy("dow", "hour")
        .agg(F.count("*").alias("pickups"))
    )


def heatmap_grid(heatmap: DataFrame) -> DataFrame:
    """One row per weekday, one column per hour, zero where nothing was picked up."""
    return heatmap.groupBy("dow").pivot("hour", list(range(24))).agg(F.sum("pickups")).na.fill(0)


def monthly_trend(monthly: DataFrame, min_trips: int = TREND_MIN_TRIPS) -> DataFrame:
    """Plottable months: those above ``min_trips``, dated, in millions."""
    return monthly.filter(F.col("trips") > min_trips).select(
        "service_type",
        F.make_date("year", "month", F.lit(1)).alias("month_date"),
        "trips",
        (F.col("trips") / 1e6).alias("trips_millions"),
    )


def long_share_by_zone(reliability: DataFrame, zones: Iterable[int]) -> DataFrame:
    """Long-trip share per zone: plain mean over rows, and weighted by trips."""
    share, trips = F.col("share_long_trips"), F.col("trip_count")
    return (
        reliability.filter(F.col("zone_id").isin(list(zones)))
        .groupBy("zone_id")
        .agg(
            F.avg(share).alias("avg_share_long"),
            F.sum(trips).alias("total_trips"),
            (F.sum(share * trips) / F.sum(trips)).alias("weighted_share_long"),
        )
    )


def label_zone_groups(
    reliability: DataFrame, groups: Mapping[str, Iterable[int]] = ZONE_GROUPS
) -> DataFrame:
    """Rows of the zones in any group, with the group's name."""
    listed = [zone for members in groups.values() for zone in members]
    return reliability.filter(F.col("zone_id").isin(listed)).select(
        "*", zone_group("zone_id", groups).alias("zone_group")
    )


def zone_group_quartiles(
    reliability: DataFrame, groups: Mapping[str, Iterable[int]] = ZONE_GROUPS
) -> DataFrame:
    """Five-number summary of the long-trip share per zone group.

    The input has one row per service, zone and hour of day, so a group stays
    small whatever the number of trips.
    """
    share = "share_long_trips"
    quartiles = F.percentile(share, F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)]))
    return (
        label_zone_groups(reliability, groups)
        .groupBy("zone_group")
        .agg(F.min(share).alias("min"), quartiles.alias("q"), F.max(share).alias("max"))
        .select(
            "zone_group",
            "min",
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
            "max",
        )
    )


def _beside_fences(reliability: DataFrame, groups: Mapping[str, Iterable[int]]) -> DataFrame:
    """Labelled rows with their group's quartiles and whether they lie within its fences; the second pass of a box plot."""
    rows, box = label_zone_groups(reliability, groups), zone_group_quartiles(reliability, groups)
    reach = FENCE * (F.col("q3") - F.col("q1")) + _NEAR
    inside = F.col("share_long_trips").between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.join(box, "zone_group").withColumn("inside", inside)


def zone_group_boxes(reliability: DataFrame, groups: Mapping[str, Iterable[int]] = ZONE_GROUPS) -> DataFrame:
    """Box plot per zone group: quartiles, whiskers (the last values within the fences) and the number of outliers."""
    inside = F.when(F.col("inside"), F.col("share_long_trips"))
    return (
        _beside_fences(reliability, groups)
        .groupBy("zone_group", "q1", "median", "q3")
        .agg(
            F.min(inside).alias("whisker_low"),
            F.max(inside).alias("whisker_high"),
            F.count_if(~F.col("inside")).alias("outliers"),
        )
    )


def zone_group_outliers(reliability: DataFrame, groups: Mapping[str, Iterable[int]] = ZONE_GROUPS) -> DataFrame:
    """The rows beyond their group's fences."""
    return _beside_fences(reliability, groups).filter("NOT inside").select("zone_group", *reliability.columns)


def duration_rank_test(
    trips: DataFrame, work: Workspace, first: str = "Airport", second: str = "Midtown", groups: Mapping[str, Iterable[int]] = ZONE_GROUPS
) -> DataFrame:
    """Whether usable trips from one zone group last longer than those from another; see ``rank_test``."""
    rows = trips.filter(usable()).select(zone_group("pu_location_id", groups).alias("zone_group"), "trip_duration_sec")
    return rank_test(rows, "zone_group", "trip_duration_sec", first, second, work)
