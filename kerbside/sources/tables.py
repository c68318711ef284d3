"""Layer tables on shared storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.schema import TRIP_COLUMNS, TRIP_SCHEMA


def save_parquet(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    mode: str = "overwrite",
    rebalance: bool = False,
    **options: str,
) -> None:
    """Write parquet.

    ``rebalance`` evens out file sizes: small partitions of a key are merged and
    a hot one is split over several tasks. Leave it off for input that is
    already clustered by the partition columns, such as monthly files.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode(mode).options(**options)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Stored trips in canonical column order and types."""
    return spark.read.schema(TRIP_SCHEMA).parquet(path).select(TRIP_COLUMNS)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a table's files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0
