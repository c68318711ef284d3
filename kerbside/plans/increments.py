"""Silver and gold kept up to date by month: what landed since the last update is all that is read."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators import partials
from kerbside.operators.harmonise import standardize_all
from kerbside.plans.months_kept import MONTH_KEYS, KeptTable, Month, in_months
from kerbside.schema import TRIP_COLUMNS, TRIP_SCHEMA
from kerbside.session import Workspace, pin_timezone
from kerbside.settings import END_MONTH, SERVICES, START_MONTH, Lake
from kerbside.sources.footers import landed_files
from kerbside.sources.months import months_of, scan_variants

_SOURCE = "src_year int, src_month int"


def kept_silver(lake: Lake) -> KeptTable:
    """Trips by the month of their file. A file's stray pickups stay with it, so that replacing it takes them along."""
    return KeptTable(f"{lake.out}/silver/trips_by_file")


def kept_partial(lake: Lake, name: str) -> KeptTable:
    return KeptTable(f"{lake.out}/partials/{name}")


def month_states(files: DataFrame) -> DataFrame:
    """Per landed month: its files' number, length, last change, footers and rows, and ``made_from``, a digest of these.

    A file counts as changed when its name, length, time or footer differs.
    """
    one = F.struct("path", "length", "modified", "footer_digest")
    listed = F.array_sort(F.collect_list(one))
    return files.groupBy("service_type", F.col("year").alias("src_year"), F.col("month").alias("src_month")).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("length"),
        F.max("modified").alias("modified"),
        F.sha2(F.array_join(F.transform(listed, lambda f: F.coalesce(f["footer_digest"], F.lit(""))), ","), 256).alias("footers"),
        F.sum("rows").alias("rows"),
        F.sha2(F.to_json(listed), 256).alias("made_from"),
    )


def update_silver(
    spark: SparkSession,
    lake: Lake,
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> list[tuple[str, int, int, str]]:
    """Write the trips of new and changed monthly files, drop those of files that are gone; returns the changed months."""
    pin_timezone(spark)
    services = list(services)
    with Workspace(spark, "landed") as work:
        files = work.store(landed_files(spark, lake, services, start, end), "files")

        def build(changed: list[Month]) -> DataFrame:
            found = months_of(files, lake, services, start, end)
            asked = [m for m in found if (m.service, m.year, m.month) in set(changed)]
            variants = [
                (service, frame)
                for service in services
                for frame in scan_variants(spark, [m for m in asked if m.service == service])
            ]
            return standardize_all(variants, keep_source_month=True)

        return kept_silver(lake).update(spark, month_states(files), build)


def read_kept_trips(spark: SparkSession, lake: Lake, *extra: str) -> DataFrame:
    """The kept trips in canonical column order; ``extra`` may name the source month's columns."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRIP_SCHEMA.fields)
    return kept_silver(lake).read(spark, f"{schema}, {_SOURCE}").select(*TRIP_COLUMNS, *extra)


def update_partials(
    spark: SparkSession, lake: Lake, names: Iterable[str] = partials.PARTIALS
) -> dict[str, list[tuple[str, int, int, str]]]:
    """Bring each stored partial to the silver months as they are; returns the changed months of each.

    A partial follows the silver manifest by its own one, so one that missed an update
    catches up with the next. Partials are independent tables and are written side by side.
    """
    pin_timezone(spark)
    wanted = kept_silver(lake).manifest(spark).select(*MONTH_KEYS, "made_from")

    def update(name: str):
        def build(changed: list[Month]) -> DataFrame:
            trips = read_kept_trips(spark, lake, "src_year", "src_month").filter(in_months(changed))
            return partials.PARTIALS[name].build(trips, ["src_year", "src_month"])

        return kept_partial(lake, name).update(spark, wanted, build, rebalance=True)

    names = list(names)
    with ThreadPoolExecutor(len(names) or 1) as pool:
        return dict(zip(names, pool.map(update, names), strict=True))


def read_partial(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return kept_partial(lake, name).read(spark, f"{partials.PARTIALS[name].schema}, {_SOURCE}")


def read_kept_mart(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """One of the three marts, merged from its stored partials."""
    mart = partials.MERGED_MARTS[name]
    return mart.merge(*[read_partial(spark, lake, source) for source in mart.sources])
