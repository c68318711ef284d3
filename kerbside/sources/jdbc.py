"""Export of curated tables over JDBC."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Environment variables of the target, and the year of the demand slice.
_ENV = {"host": "PG_HOST", "port": "PG_PORT", "db": "PG_DB", "user": "PG_USER", "password": "PG_PASSWORD"}
_DEFAULT_PORT = "5432"
_DRIVER = "org.postgresql.Driver"
EXPORT_YEAR = 2025

# How many tasks hold a database connection at once, unless the caller says otherwise.
CONNECTIONS = 8


def target_from_env(
    env: Mapping[str, str] | None = None, connections: int = CONNECTIONS
) -> tuple[str, dict[str, str]] | None:
    """JDBC url and properties, None when the environment names no complete target."""
    env = os.environ if env is None else env
    given = {key: env.get(variable) for key, variable in _ENV.items()}
    if not all(given[key] for key in ("host", "db", "user", "password")):
        return None
    url = f"jdbc:postgresql://{given['host']}:{given['port'] or _DEFAULT_PORT}/{given['db']}"
    properties = {
        "user": given["user"],
        "password": given["password"],
        "driver": _DRIVER,
        "batchsize": "10000",
        "numPartitions": str(connections),
    }
    return url, properties


def export_table(
    df: DataFrame, table: str, mode: str = "overwrite", env: Mapping[str, str] | None = None
) -> bool:
    """Write one table; False when no target is configured."""
    target = target_from_env(env)
    if target is None:
        return False
    url, properties = target
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)
    return True


def year_slice(demand: DataFrame, year: int = EXPORT_YEAR) -> DataFrame:
    """Demand rows of one year, as a timestamp range so that the scan can skip files."""
    lower, upper = (F.make_timestamp(*[F.lit(v) for v in (y, 1, 1, 0, 0, 0)]) for y in (year, year + 1))
    return demand.filter((F.col("ts_hour") >= lower) & (F.col("ts_hour") < upper))


def export_curated(
    monthly: DataFrame,
    metrics: DataFrame,
    timings: DataFrame,
    demand: DataFrame | None = None,
    prefix: str = "",
    env: Mapping[str, str] | None = None,
    year: int = EXPORT_YEAR,
) -> dict[str, bool]:
    """Export the curated set, one outcome per target table.

    Demand is exported as given; ``year`` only names its table. Cut it with
    ``year_slice`` first.
    """
    frames = {
        "monthly_service_summary": monthly,
        "model_metrics": metrics,
        "perf_timings": timings,
    }
    if demand is not None:
        frames[f"zone_hour_demand_{year}"] = demand
    return {prefix + name: export_table(df, prefix + name, env=env) for name, df in frames.items()}
