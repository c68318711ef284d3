"""Literal trips for the unit tests."""

import datetime as dt

from pyspark.sql import functions as F

from kerbside.operators.harmonise import with_derived
from kerbside.schema import raw_backed_fields

START = dt.datetime(2024, 12, 1, 8, 0, 0)


def trips(spark, rows):
    """Trips from dicts: service, at, seconds, pu, do, amount, distance."""
    fields = raw_backed_fields()
    schema = "service_type string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    return with_derived(spark.createDataFrame([_row(**r) for r in rows], schema))


def _row(service="yellow", at=START, seconds=600, pu=1, do=2, amount=10.0, distance=2.0):
    end = None if at is None or seconds is None else at + dt.timedelta(seconds=seconds)
    return (service, at, end, pu, do, 1, distance, amount, amount)


def demand(spark, rows):
    """Demand mart rows from (service, zone, hour offset, pickups)."""
    data = [(s, z, START + dt.timedelta(hours=h), p, 1.0, 1.0, 60.0, 90.0) for s, z, h, p in rows]
    schema = (
        "service_type string, zone_id int, ts_hour timestamp, pickups bigint, avg_total_amount double, "
        "avg_trip_distance double, p50_duration double, p95_duration double"
    )
    return spark.createDataFrame(data, schema)


def shuffled(df):
    return df.orderBy(F.rand(7))
