"""Rewrite monthly files with another compression codec, and prove that nothing else changed."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import Workspace, move_path
from kerbside.settings import END_MONTH, SERVICES, START_MONTH, Lake
from kerbside.sources.months import Month, probe_months, scan_variants, union_aligned
from kerbside.sources.tables import save_parquet

# Layout of months written by one job: a folder per month, named by its file.
MONTH_FOLDERS = "{root}/month_file={service}_tripdata_{year:04d}-{month:02d}.parquet"


def write_months(raw: DataFrame, root: str, service: str, year: str, month: str, compression: str) -> None:
    """Write one service's raw rows as month folders.

    Only the months present in ``raw`` are replaced, so the variants of a
    service can be written one after the other and a rerun repeats nothing.
    """
    name = F.format_string(f"{service}_tripdata_%04d-%02d.parquet", year, month)
    save_parquet(
        raw.withColumn("month_file", name).drop("service_type", year, month),
        root,
        ("month_file",),
        rebalance=True,
        compression=compression,
        partitionOverwriteMode="dynamic",
    )


def recode_months(
    spark: SparkSession,
    lake: Lake,
    target: str,
    compression: str = "snappy",
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> Lake:
    """Rewrite the landed months below ``target``, types and headers as they are; returns where to read."""
    services = list(services)
    months = probe_months(spark, lake, services, start, end)
    for service in services:
        for raw in scan_variants(spark, [m for m in months if m.service == service]):
            write_months(raw, target, service, "src_year", "src_month", compression)
    return replace(lake, raw=target, month_layout=MONTH_FOLDERS)


_KEYS = ["service_type", "year", "month"]


def month_digests(spark: SparkSession, months: Iterable[Month]) -> DataFrame:
    """Rows and an order-free digest per landed month: service_type, year, month, rows, digest.

    The digest adds up one hash of every row and combines another one bit by bit; both
    are of all raw columns with their names and types, whatever their order. Counts and
    digests are combined on the map side.
    """
    sides = []
    for scan in scan_variants(spark, months):
        own = sorted((f.name, f.dataType.simpleString()) for f in scan.schema.fields if f.name not in ("service_type", "src_year", "src_month"))
        columns = [F.lit(repr(own)), *[F.col(f"`{name}`") for name, _ in own]]
        sides.append(
            scan.groupBy("service_type", F.col("src_year").alias("year"), F.col("src_month").alias("month")).agg(
                F.count("*").alias("rows"),
                F.sum(F.xxhash64(F.lit(1), *columns).cast("decimal(38,0)")).alias("total"),
                F.bit_xor(F.xxhash64(F.lit(2), *columns)).alias("bits"),
            )
        )
    if not sides:
        return spark.createDataFrame([], "service_type string, year int, month int, rows bigint, digest string")
    merged = union_aligned(sides).groupBy(*_KEYS).agg(
        F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.bit_xor("bits").alias("bits")
    )
    return merged.select(*_KEYS, "rows", F.concat_ws(":", "rows", "total", "bits").alias("digest"))


def recode_proof(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per month of either side: rows before and after, and whether the digests agree."""
    left = before.select(*_KEYS, F.col("rows").alias("rows_before"), F.col("digest").alias("__before"))
    right = after.select(*_KEYS, F.col("rows").alias("rows_after"), F.col("digest").alias("__after"))
    equal = F.coalesce(F.col("__before") == F.col("__after"), F.lit(False))
    return left.join(right, _KEYS, "full").select(*_KEYS, "rows_before", "rows_after", equal.alias("equal"))


def adopt_proven(
    spark: SparkSession,
    lake: Lake,
    staged: Lake,
    target: str,
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> tuple[Lake, DataFrame]:
    """Move the staged months that hold exactly the rows of ``lake`` below ``target``; where to read them, and the proof.

    A month that differs is refused: it stays where it was staged, and what ``target`` had
    of it stays too. Files without rows leave no month folder and appear in neither.
    """
    services = list(services)
    with Workspace(spark, "proof") as work:
        sides = [month_digests(spark, probe_months(spark, place, services, start, end)) for place in (lake, staged)]
        proof = work.store(recode_proof(*sides), "proof")
        rows = [tuple(row) for row in proof.collect()]
        schema = proof.schema
    adopted = replace(staged, raw=target)
    for service, year, month, _, _, equal in rows:
        if equal:
            move_path(spark, staged.month_path(service, year, month), adopted.month_path(service, year, month))
    return adopted, spark.createDataFrame(rows, schema)


def recode_proven(
    spark: SparkSession,
    lake: Lake,
    target: str,
    compression: str = "snappy",
    services: Iterable[str] = SERVICES,
    start: str = START_MONTH,
    end: str = END_MONTH,
) -> tuple[Lake, DataFrame]:
    """``recode_months`` into a folder beside ``target``, then ``adopt_proven``; refused months stay in that folder."""
    services = list(services)
    staged = recode_months(spark, lake, f"{target.rstrip('/')}_staged", compression, services, start, end)
    return adopt_proven(spark, lake, staged, target, services, start, end)
