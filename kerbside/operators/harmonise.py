"""Raw service frames to canonical trips."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.trips import coerced, derived_columns
from kerbside.schema import SERVICE_COLUMNS, TRIP_COLUMNS, raw_backed_fields
from kerbside.sources.months import union_aligned


def with_derived(df: DataFrame) -> DataFrame:
    """Canonical trips from a frame that has the service and the raw-backed columns."""
    raw_backed = [field.name for field in raw_backed_fields()]
    return df.select("service_type", *raw_backed, *derived_columns())


def standardize(
    df: DataFrame, service: str, flag_source_month: bool = False, keep_source_month: bool = False
) -> DataFrame:
    """Project one service's raw frame to the canonical schema.

    ``flag_source_month`` adds ``in_source_month``: whether the pickup lies in
    the month its file is named for; ``keep_source_month`` adds that month as
    ``src_year`` and ``src_month`` (both need a frame loaded with provenance).
    """
    if service not in SERVICE_COLUMNS:
        raise ValueError(f"Unknown service type: {service!r}")
    columns = SERVICE_COLUMNS[service]
    source = ["src_year", "src_month"] if flag_source_month or keep_source_month else []
    raw = df.select(
        F.lit(service).alias("service_type"),
        *[coerced(df, columns.for_column(field.name), field) for field in raw_backed_fields()],
        *source,
    )
    pickup = F.col("pickup_datetime")
    matches = (F.year(pickup) == F.col("src_year")) & (F.month(pickup) == F.col("src_month"))
    flag = [F.coalesce(matches, F.lit(False)).alias("in_source_month")] if flag_source_month else []
    return raw.select(*TRIP_COLUMNS[:9], *derived_columns(), *flag, *(source if keep_source_month else []))


def standardize_all(
    variants: Iterable[tuple[str, DataFrame]], flag_source_month: bool = False, keep_source_month: bool = False
) -> DataFrame:
    """Harmonise (service, raw frame) pairs and stack them; never pads raw columns first."""
    return union_aligned(standardize(df, service, flag_source_month, keep_source_month) for service, df in variants)
