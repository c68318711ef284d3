"""Monthly trip files: what is expected, what is there, and how to scan it.

One listing finds the files and one job reads their footers. Files with the same
columns and types share one scan, so the number of plan branches and of the
driver's own reads follows the number of variants, not the number of files.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.trips import parse_month
from kerbside.settings import END_MONTH, SERVICES, START_MONTH, Lake
from kerbside.sources.footers import landed_files

_BEFORE_MONTH, _MONTH = "_tripdata_", r"(\d{4})-(\d{2})"


@dataclass(frozen=True)
class Month:
    """``variants``: per variant of columns and types, what to read; none where the month is absent."""

    service: str
    year: int
    month: int
    variants: dict[str, tuple[str, ...]]

    @property
    def landed(self) -> bool:
        return bool(self.variants)


def month_spine(spark: SparkSession, start: str = START_MONTH, end: str = END_MONTH) -> DataFrame:
    """(year, month) rows from start to end, both included."""
    first, last = (F.to_date(F.lit(f"{m}-01")) for m in (start, end))
    if parse_month(start) > parse_month(end):
        return spark.createDataFrame([], "year int, month int")
    months = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("first_day")
    return spark.range(1).select(months).select(
        F.year("first_day").alias("year"), F.month("first_day").alias("month")
    )


def expected_months(
    spark: SparkSession,
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> DataFrame:
    """One row per service and month that should exist."""
    names = F.explode(F.array(*[F.lit(s) for s in services])).alias("service_type")
    return month_spine(spark, start, end).select(names, "year", "month")


def spanned_months(rows: DataFrame, time: str, services: Iterable[str] = SERVICES) -> DataFrame:
    """One row per service and month between the first and the last time; none without rows."""
    first, last = (F.trunc(f(time).cast("date"), "month") for f in (F.min, F.max))
    spine = rows.agg(first.alias("first"), last.alias("last")).filter("first IS NOT NULL")
    months = spine.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))).alias("first_day"))
    names = F.explode(F.array(*[F.lit(s) for s in services])).alias("service_type")
    return months.select(names, F.year("first_day").alias("year"), F.month("first_day").alias("month"))


def expected_file_counts(expected: DataFrame) -> DataFrame:
    """Expected files per service."""
    return expected.groupBy("service_type").agg(F.count("*").alias("expected_files"))


def missing_months(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected service-months without data."""
    return expected.join(landed, ["service_type", "year", "month"], "left_anti")


def try_read(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet at ``path``, or None when nothing is there. Any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def probe_months(
    spark: SparkSession,
    lake: Lake,
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> list[Month]:
    """Every expected month and what its files hold."""
    services = list(services)
    return months_of(landed_files(spark, lake, services, start, end), lake, services, start, end)


def months_of(
    files: DataFrame,
    lake: Lake,
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> list[Month]:
    """Every expected month and its landed files.

    A month whose files agree is read as a whole, be it a file or a folder. The
    driver holds a row per file, as it does for any scan of them.
    """
    found: dict[tuple, dict[str, list[str]]] = {}
    for row in files.select("service_type", "year", "month", "variant", "path").collect():
        found.setdefault((row.service_type, row.year, row.month), {}).setdefault(row.variant, []).append(row.path)
    first, last = parse_month(start), parse_month(end)
    calendar = [
        (year, month)
        for year in range(first[0], last[0] + 1)
        for month in range(1, 13)
        if first <= (year, month) <= last
    ]

    def month(service: str, year: int, month: int) -> Month:
        variants = found.get((service, year, month), {})
        if len(variants) == 1:
            return Month(service, year, month, {next(iter(variants)): (lake.month_path(service, year, month),)})
        return Month(service, year, month, {variant: tuple(sorted(paths)) for variant, paths in sorted(variants.items())})

    return [month(s, y, m) for s in services for y, m in calendar]


def month_report(spark: SparkSession, months: list[Month]) -> DataFrame:
    """Probe outcome as a table: service_type, year, month, landed."""
    rows = [(m.service, m.year, m.month, m.landed) for m in months]
    return spark.createDataFrame(rows, "service_type string, year int, month int, landed boolean")


def variant_schemas(spark: SparkSession, months: Iterable[Month]) -> dict[tuple[str, str], T.StructType]:
    """Columns and types by service and variant, asked of one file each."""
    examples = {(m.service, variant): paths[0] for m in months for variant, paths in m.variants.items()}
    return {key: spark.read.parquet(path).schema for key, path in examples.items()}


def month_columns(spark: SparkSession, months: list[Month]) -> DataFrame:
    """The raw columns of every landed month: service_type, year, month, column_name, data_type."""
    schemas = [
        (service, variant, field.name, field.dataType.simpleString())
        for (service, variant), schema in variant_schemas(spark, months).items()
        for field in schema.fields
    ]
    columns = spark.createDataFrame(schemas, "service_type string, variant string, column_name string, data_type string")
    held = [(m.service, m.year, m.month, variant) for m in months for variant in m.variants]
    landed = spark.createDataFrame(held, "service_type string, year int, month int, variant string")
    return landed.join(columns, ["service_type", "variant"]).drop("variant").distinct()


def scan_variants(spark: SparkSession, months: Iterable[Month]) -> list[DataFrame]:
    """One scan per service and variant of columns and types, with where each row came from."""
    months = list(months)
    paths: dict[tuple[str, str], list[str]] = {}
    for month in months:
        for variant, held in month.variants.items():
            paths.setdefault((month.service, variant), []).extend(held)
    schemas = variant_schemas(spark, months)
    return [_scan(spark, key[0], schemas[key], members) for key, members in paths.items()]


def _scan(spark: SparkSession, service: str, schema: T.StructType, paths: list[str]) -> DataFrame:
    frame = spark.read.schema(schema).parquet(*paths)
    return frame.withColumns(
        {
            "service_type": F.lit(service),
            "src_year": _month_part("_metadata.file_path", 1),
            "src_month": _month_part("_metadata.file_path", 2),
        }
    )


def _month_part(path: str, group: int) -> Column:
    """Year (1) or month (2) in a path. Every row asks, so the whole path is matched only where its end has no month."""
    end = F.substring_index(path, _BEFORE_MONTH, -1)
    return F.coalesce(
        F.regexp_extract(end, rf"^{_MONTH}", group).try_cast("int"),
        F.regexp_extract(path, rf".*{_BEFORE_MONTH}{_MONTH}", group).cast("int"),
    )


def union_aligned(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns a frame lacks become typed nulls, case is ignored."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_service_raw(
    spark: SparkSession, lake: Lake, service: str, start: str = START_MONTH, end: str = END_MONTH
) -> DataFrame | None:
    """All raw columns of one service's months in one frame; None when no month exists."""
    return load_all_raw(spark, lake, [service], start, end).get(service)


def load_all_raw(
    spark: SparkSession,
    lake: Lake,
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> dict[str, DataFrame]:
    """Raw frames by service, services without files left out; one listing for all."""
    services = list(services)
    months = probe_months(spark, lake, services, start, end)
    scans = {s: scan_variants(spark, [m for m in months if m.service == s]) for s in services}
    return {service: union_aligned(variants) for service, variants in scans.items() if variants}


def probe_schema(spark: SparkSession, path: str, rows: int = 3) -> tuple[T.StructType, DataFrame] | None:
    """Schema and a few rows of one file, None when it is absent."""
    found = try_read(spark, path)
    return None if found is None else (found.schema, found.limit(rows))
