"""Partial results per source month that merge into the marts, exactly.

A partial keeps what adds up: how many trips of a group had which duration, sums and
counts, zone sets as bitmaps. Merging adds counts and joins bitmaps, so a mart over
all months never reads a trip of a month that did not change, and a trip whose
pickup strayed into another month's hours still meets them there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.trips import usable
from kerbside.operators import marts

_DURATION = "trip_duration_sec double, n bigint"
_MONTH = "service_type string, year int, month int"
# Size of a quantile sketch, and the rank error it stays within (five standard errors of one rank).
SKETCH_SIZE = 400
RANK_ERROR = 0.02


def duration_counts(trips: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Valid trips per service, pickup month and duration."""
    return trips.filter("valid_time").groupBy("service_type", "year", "month", "trip_duration_sec", *more).agg(
        F.count("*").alias("n")
    )


def zone_sets(trips: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Pickup zones of valid trips per service and pickup month, one bit each; 4 KB per 32,768 zone numbers."""
    zone = F.col("pu_location_id")
    return (
        trips.filter("valid_time AND pu_location_id IS NOT NULL")
        .groupBy("service_type", "year", "month", F.bitmap_bucket_number(zone).alias("bucket"), *more)
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(zone)).alias("zones"))
    )


def distinct_zones(sets: DataFrame, *by: Column | str) -> DataFrame:
    """Number of different zones per group of ``by``, any coarser one than the sets have, without the trips."""
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    merged = sets.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("zones")).alias("zones"))
    names = merged.columns[: len(keys)]
    return merged.groupBy(*names).agg(F.sum("zones").alias("unique_pu_zones"))


def zones_by_quarter(sets: DataFrame) -> DataFrame:
    """Different pickup zones per service and quarter, from the months' sets."""
    quarter = F.ceil(F.col("month") / 3).cast("int").alias("quarter")
    return distinct_zones(sets, "service_type", "year", quarter)


def reliability_counts(trips: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Usable trips and long ones per service, zone and hour of day."""
    return (
        trips.filter(usable())
        .groupBy("service_type", F.col("pu_location_id").alias("zone_id"), "hour", *more)
        .agg(F.count("*").alias("trip_count"), F.count_if(marts.is_long()).alias("long_count"))
    )


def duration_sketches(trips: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """A quantile sketch of valid trips' durations per service and pickup month: a few KB however many trips.

    For values without a small bound; whole seconds are counted exactly by ``duration_counts``.
    """
    return trips.filter("valid_time").groupBy("service_type", "year", "month", *more).agg(
        F.kll_sketch_agg_double("trip_duration_sec", SKETCH_SIZE).alias("sketch")
    )


def sketched_quantiles(sketches: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``keys``, share and the approximate quantile at it, from merged sketches; the rank is off by ``RANK_ERROR`` at most."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"))
    found = [
        F.struct(F.lit(share).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias("quantile"))
        for share in shares
    ]
    return merged.select(*keys, F.inline(F.array(*found)))


def rank_errors(quantiles: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The quantiles with ``rank_error``: how far their share lies outside the exact ranks of their value.

    ``counts`` has one row per ``keys`` and duration. A value's exact ranks reach from the
    share of smaller values to the share of values up to it.
    """
    value, n = F.col("trip_duration_sec"), F.col("n")
    ranked = quantiles.join(counts, list(keys)).groupBy(*keys, "share", "quantile").agg(
        (F.sum(F.when(value < F.col("quantile"), n).otherwise(0)) / F.sum(n)).alias("low"),
        (F.sum(F.when(value <= F.col("quantile"), n).otherwise(0)) / F.sum(n)).alias("high"),
    )
    gap = F.greatest(F.col("low") - F.col("share"), F.col("share") - F.col("high"), F.lit(0.0))
    return ranked.select(*keys, "share", "quantile", gap.alias("rank_error"))


def merged_demand(counts: DataFrame) -> DataFrame:
    """``marts.zone_hour_demand`` from stored counts."""
    keys = ["service_type", "zone_id", "ts_hour", "trip_duration_sec"]
    values = [F.sum(c).alias(c) for c in ("n", "amount", "amount_n", "distance", "distance_n")]
    return marts.demand_from_counts(counts.groupBy(*keys).agg(*values))


def merged_monthly(durations: DataFrame, sets: DataFrame) -> DataFrame:
    """``marts.monthly_service_summary`` from stored counts and zone sets."""
    keys = ["service_type", "year", "month"]
    counts = durations.groupBy(*keys, "trip_duration_sec").agg(F.sum("n").alias("n"))
    zones = distinct_zones(sets, *keys)
    joined = marts.durations_summary(counts, keys).join(zones, keys, "left")
    return joined.select(
        *keys, "trips", F.coalesce("unique_pu_zones", F.lit(0)).alias("unique_pu_zones"), "avg_duration_sec", "p95_duration_sec"
    )


def merged_reliability(counts: DataFrame) -> DataFrame:
    """``marts.zone_hour_reliability`` from stored counts."""
    trips, long = F.sum("trip_count"), F.sum("long_count")
    return counts.groupBy("service_type", "zone_id", "hour").agg(
        trips.alias("trip_count"), (long / trips).alias("share_long_trips")
    )


@dataclass(frozen=True)
class Partial:
    """``build`` takes trips and the columns of their source month; ``schema`` is its result's, without these."""

    build: Callable[[DataFrame, Sequence[str]], DataFrame]
    schema: str


@dataclass(frozen=True)
class MergedMart:
    sources: tuple[str, ...]
    merge: Callable[..., DataFrame]


PARTIALS = {
    "demand_counts": Partial(
        marts.demand_counts,
        f"service_type string, zone_id int, ts_hour timestamp, {_DURATION}, "
        "amount double, amount_n bigint, distance double, distance_n bigint",
    ),
    "duration_counts": Partial(duration_counts, f"{_MONTH}, {_DURATION}"),
    "zone_sets": Partial(zone_sets, f"{_MONTH}, bucket bigint, zones binary"),
    "duration_sketches": Partial(duration_sketches, f"{_MONTH}, sketch binary"),
    "reliability_counts": Partial(
        reliability_counts, "service_type string, zone_id int, hour int, trip_count bigint, long_count bigint"
    ),
}
MERGED_MARTS = {
    "zone_hour_demand": MergedMart(("demand_counts",), merged_demand),
    "monthly_service_summary": MergedMart(("duration_counts", "zone_sets"), merged_monthly),
    "zone_hour_reliability": MergedMart(("reliability_counts",), merged_reliability),
}
