"""Expressions over trip columns: lookup, coercion, calendar parts, quality flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.settings import MAX_TRIP_SECONDS


def find_column(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """First candidate present in the frame, ignoring case."""
    present = {name.lower(): name for name in df.columns}
    return next((present[c.lower()] for c in candidates if c.lower() in present), None)


def coerced(df: DataFrame, candidates: Iterable[str], field: T.StructField) -> Column:
    """The raw column under its canonical name and type; typed null when absent or not castable."""
    source = find_column(df, candidates)
    if source is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return F.col(f"`{source}`").try_cast(field.dataType).alias(field.name)


def duration_seconds(start: str, end: str) -> Column:
    """Whole seconds between two timestamps."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)).cast("double")


def derived_columns() -> list[Column]:
    """Calendar parts, duration and flags of a frame that has the raw-backed columns."""
    pickup = F.col("pickup_datetime")
    duration = duration_seconds("pickup_datetime", "dropoff_datetime")
    in_range = (duration > 0) & (duration <= MAX_TRIP_SECONDS)
    return [
        F.year(pickup).alias("year"),
        F.month(pickup).alias("month"),
        F.dayofmonth(pickup).alias("day"),
        F.hour(pickup).alias("hour"),
        F.dayofweek(pickup).alias("dow"),
        duration.alias("trip_duration_sec"),
        F.coalesce(in_range, F.lit(False)).alias("valid_time"),
        both_known("pu_location_id", "do_location_id").alias("valid_locations"),
    ]


def both_known(left: str, right: str) -> Column:
    return F.col(left).isNotNull() & F.col(right).isNotNull()


def usable() -> Column:
    """Trips the zone marts count: time and both locations are valid."""
    return F.col("valid_time") & F.col("valid_locations")


def month_index(year: Column | str, month: Column | str) -> Column:
    """Months since year 0, so that month ranges become integer ranges."""
    year, month = (F.col(c) if isinstance(c, str) else c for c in (year, month))
    return year * 12 + month - 1


def parse_month(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    return int(year), int(month)


def zone_group(zone: str, groups: Mapping[str, Iterable[int]]) -> Column:
    """Name of the first group that lists the zone; null for other zones."""
    label = F.lit(None).cast("string")
    for name, members in reversed(list(groups.items())):
        label = F.when(F.col(zone).isin(list(members)), F.lit(name)).otherwise(label)
    return label
