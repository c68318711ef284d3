"""Raw months to stored trips, stored trips to stored marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kerbside.operators import marts
from kerbside.operators.harmonise import standardize_all
from kerbside.operators.timing import time_cached_and_uncached
from kerbside.plans.subset import load_subset
from kerbside.session import pin_timezone
from kerbside.settings import END_MONTH, SERVICES, START_MONTH, Lake
from kerbside.sources.months import month_report, probe_months, scan_variants
from kerbside.sources.tables import read_trips, save_parquet


@dataclass(frozen=True)
class Mart:
    build: Callable[[DataFrame], DataFrame]
    partition_cols: tuple[str, ...] = ()


MARTS = {
    "zone_hour_demand": Mart(marts.zone_hour_demand, ("service_type",)),
    "monthly_service_summary": Mart(marts.monthly_service_summary),
    "zone_hour_reliability": Mart(marts.zone_hour_reliability),
}


def load_trips(
    spark: SparkSession,
    lake: Lake,
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
    flag_source_month: bool = False,
) -> tuple[DataFrame | None, DataFrame]:
    """Canonical trips of all landed months (None when there are none), and the month report.

    Each footer variant is projected to the canonical schema before the union,
    so months that spell, type or order their columns differently keep their values.
    """
    pin_timezone(spark)
    months = probe_months(spark, lake, services, start, end)
    variants = [
        (service, frame)
        for service in services
        for frame in scan_variants(spark, [m for m in months if m.service == service])
    ]
    trips = standardize_all(variants, flag_source_month) if variants else None
    return trips, month_report(spark, months)


def build_silver(
    spark: SparkSession,
    lake: Lake,
    mode: str = "full",
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
    rebalance: bool = False,
) -> DataFrame | None:
    """The trips table: built from raw months ("full"), as stored ("reuse"), or the subset ("subset").

    Monthly files already arrive grouped by service and month, so a full build
    writes without a shuffle; ``rebalance`` is for input that is not.
    """
    pin_timezone(spark)
    if mode == "subset":
        return load_subset(spark, lake)
    if mode == "full":
        trips, _ = load_trips(spark, lake, tuple(services), start, end)
        if trips is None:
            return None
        save_parquet(trips, lake.silver, ("service_type", "year", "month"), rebalance=rebalance)
    elif mode != "reuse":
        raise ValueError(f"Unknown mode: {mode!r}")
    return read_trips(spark, lake.silver)


def build_marts(spark: SparkSession, lake: Lake, trips: DataFrame) -> dict[str, DataFrame]:
    """Write the three marts and return them as stored."""
    pin_timezone(spark)
    for name, mart in MARTS.items():
        save_parquet(mart.build(trips), lake.gold(name), mart.partition_cols, rebalance=True)
    return read_marts(spark, lake)


def read_marts(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(lake.gold(name)) for name in MARTS}


def record_timings(spark: SparkSession, lake: Lake, demand: DataFrame) -> DataFrame:
    """Time the zone aggregation on the stored mart and store the result."""
    timings = time_cached_and_uncached(spark, demand)
    save_parquet(timings, lake.gold("perf_timings"))
    return timings
