"""A small stored subset: the busiest pickup zones of one service-month, or a sample of a given size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.ranks import with_total_before
from kerbside.operators.harmonise import standardize_all
from kerbside.operators.insights import keep_members, top_by
from kerbside.schema import TRIP_SCHEMA
from kerbside.session import Workspace, pin_timezone
from kerbside.settings import SUBSET_BYTES, SUBSET_MONTH, SUBSET_SERVICE, SUBSET_ZONES, Lake
from kerbside.sources.months import probe_months, scan_variants, try_read
from kerbside.sources.tables import read_trips, save_parquet, stored_bytes

# Hexadecimal digits of a row's digest that place it: 16.8 million places, 6 MB each of 100 TB.
_PLACE_DIGITS = 6
_WIDTHS = {"timestamp": 8, "double": 8, "int": 4, "boolean": 1}


def busiest_pickup_zones(trips: DataFrame, n: int) -> DataFrame:
    """Zones by trip count. Trips without a zone compete for a place but match no row later."""
    counts = trips.groupBy("pu_location_id").agg(F.count("*").alias("trips"))
    return top_by(counts, "pu_location_id", "trips", n)


def keep_busiest_zones(trips: DataFrame, n: int = SUBSET_ZONES) -> DataFrame:
    zones = busiest_pickup_zones(trips, n).select("pu_location_id")
    return keep_members(trips, zones, "pu_location_id")


def one_month(spark: SparkSession, lake: Lake, service: str, month: str) -> DataFrame | None:
    """Canonical trips of one service-month, None when it has not landed."""
    found = scan_variants(spark, probe_months(spark, lake, [service], month, month))
    return standardize_all((service, frame) for frame in found) if found else None


def make_subset(
    spark: SparkSession,
    lake: Lake,
    month: str = SUBSET_MONTH,
    service: str = SUBSET_SERVICE,
    max_zones: int = SUBSET_ZONES,
) -> DataFrame | None:
    """Write the subset and return it as stored, so that counting it computes nothing twice."""
    pin_timezone(spark)
    trips = one_month(spark, lake, service, month)
    if trips is None:
        return None
    save_parquet(keep_busiest_zones(trips, max_zones), lake.subset)
    return read_trips(spark, lake.subset)


def load_subset(
    spark: SparkSession, lake: Lake, month: str = SUBSET_MONTH, service: str = SUBSET_SERVICE
) -> DataFrame | None:
    """The stored subset, or the raw month when none is stored."""
    pin_timezone(spark)
    if try_read(spark, lake.subset) is not None:
        return read_trips(spark, lake.subset)
    return one_month(spark, lake, service, month)


def plain_bytes() -> Column:
    """Bytes of a canonical trip without encoding or compression: what stored files stay below."""
    fixed = sum(_WIDTHS.get(f.dataType.simpleString(), 0) for f in TRIP_SCHEMA.fields)
    return F.octet_length("service_type") + 4 + fixed


def sample_place() -> Column:
    """Where a trip lies in the order of sampling: the first digits of a digest of its service, times and zones."""
    times = [F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("pickup_datetime", "dropoff_datetime")]
    digest = F.md5(F.concat_ws("|", "service_type", *times, "pu_location_id", "do_location_id"))
    return F.conv(F.substring(digest, 1, _PLACE_DIGITS), 16, 10).cast("bigint")


def sample_of_size(trips: DataFrame, work: Workspace, max_bytes: int = SUBSET_BYTES) -> DataFrame:
    """As many trips as fit into ``max_bytes`` by ``plain_bytes``, in the order of ``sample_place``.

    One pass adds up bytes per place; the first place that no longer fits ends the
    sample. Trips of one place come together. The sample for a smaller size is part of
    that for a larger one, and reruns agree.
    """
    places = trips.groupBy(sample_place().alias("place")).agg(F.sum(plain_bytes()).alias("bytes"))
    over = with_total_before(places, "place", "bytes", work).filter(F.col("before") + F.col("bytes") > max_bytes)
    end = over.agg(F.min("place")).first()[0]
    return trips if end is None else trips.filter(sample_place() < end)


def make_sized_subset(spark: SparkSession, lake: Lake, trips: DataFrame, max_bytes: int = SUBSET_BYTES) -> DataFrame:
    """Write a sample of canonical trips as the subset and return it as stored; its files hold ``max_bytes`` at most."""
    pin_timezone(spark)
    with Workspace(spark, "sample") as work:
        save_parquet(sample_of_size(trips, work, max_bytes).coalesce(1 + max_bytes // (128 << 20)), lake.subset)
    stored = stored_bytes(spark, lake.subset)
    if stored > max_bytes:
        raise RuntimeError(f"the subset takes {stored} bytes of {max_bytes}: too few for a file's own footer")
    return read_trips(spark, lake.subset)
