"""Data-quality tables over canonical trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.trips import usable


def quality_overview(trips: DataFrame) -> DataFrame:
    """Total and usable rows and the usable percentage, in one pass; null percentage for no rows."""
    counts = trips.agg(F.count("*").alias("total_rows"), F.count_if(usable()).alias("valid_rows"))
    share = F.col("valid_rows") * 100.0 / F.nullif(F.col("total_rows"), F.lit(0))
    return counts.select("*", share.alias("valid_pct"))


def rows_by_service(trips: DataFrame) -> DataFrame:
    return trips.groupBy("service_type").agg(F.count("*").alias("rows"))


def zone_profile(trips: DataFrame) -> DataFrame:
    """Distinct, lowest and highest pickup zone per service."""
    zone = "pu_location_id"
    return trips.groupBy("service_type").agg(
        F.countDistinct(zone).alias("distinct_zones"),
        F.min(zone).alias("min_zone"),
        F.max(zone).alias("max_zone"),
    )


def null_profile(trips: DataFrame) -> DataFrame:
    """Non-null values per service of the columns the marts rely on."""
    checked = {
        "total_amount": "non_null_total_amount",
        "trip_distance": "non_null_trip_distance",
        "trip_duration_sec": "non_null_duration",
        "pu_location_id": "non_null_pu_loc",
    }
    return trips.groupBy("service_type").agg(*[F.count(c).alias(name) for c, name in checked.items()])
