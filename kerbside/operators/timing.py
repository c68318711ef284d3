"""How long an aggregation takes with and without a cached input."""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def demand_by_zone(demand: DataFrame) -> DataFrame:
    """Total pickups and mean of the hourly mean amounts per service and zone."""
    return demand.groupBy("service_type", "zone_id").agg(
        F.sum("pickups").alias("total_pickups"),
        F.avg("avg_total_amount").alias("mean_amount"),
    )


def seconds_to_compute(df: DataFrame) -> float:
    """Time to produce every column; a count would let the optimizer drop the aggregates."""
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def time_cached_and_uncached(
    spark: SparkSession, demand: DataFrame, label: str = "zone_hour_demand"
) -> DataFrame:
    """experiment, elapsed_sec of the zone aggregation on the frame as it is, then cached.

    Each kind runs once unmeasured, so that neither pays for compiling.
    """
    seconds_to_compute(demand_by_zone(demand))
    uncached = seconds_to_compute(demand_by_zone(demand))
    cached_frame = demand.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seconds_to_compute(demand_by_zone(cached_frame))
        cached = seconds_to_compute(demand_by_zone(cached_frame))
    finally:
        cached_frame.unpersist(blocking=True)
    rows = [(f"{label}_no_cache", round(uncached, 3)), (f"{label}_cached", round(cached, 3))]
    return spark.createDataFrame(rows, "experiment string, elapsed_sec double")
