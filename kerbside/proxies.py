"""Trips derived from the general-purpose test tables, as FIXTURES.md defines them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.harmonise import with_derived
from kerbside.schema import raw_backed_fields
from kerbside.settings import SERVICES

# Pickup zones by user, service by return flag.
EVENT_ZONES = (132, 138, 1, 161, 162, 163, 237, 236, 230, 142)
FLAG_SERVICES = {"A": "yellow", "N": "green", "R": "fhv"}


def _plus_seconds(timestamp: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("bigint"), timestamp)


def _typed(df: DataFrame) -> DataFrame:
    return df.select("service_type", *[F.col(f.name).cast(f.dataType) for f in raw_backed_fields()])


def event_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped rides from events: ids as int64, wall-clock timestamps, service by event id."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    service = F.element_at(F.array(*[F.lit(s) for s in SERVICES]), (event % 3 + 1).cast("int"))
    pickup = F.col("ts") + F.expr("INTERVAL 350 DAYS")
    back_in_time = event % 43 == 0
    ride_seconds = F.when(back_in_time, F.lit(-60)).otherwise(F.round(value * 60))
    zones = F.array(*[F.lit(z).cast("bigint") for z in EVENT_ZONES])
    return events.select(
        service.alias("service_type"),
        "event_id",
        pickup.alias("pickup_datetime"),
        F.when(event % 41 != 0, _plus_seconds(pickup, ride_seconds)).alias("dropoff_datetime"),
        F.element_at(zones, (user % 10 + 1).cast("int")).alias("pu_location_id"),
        (user % 265 + 1).alias("do_location_id"),
        (user % 6 + 1).alias("passenger_count"),
        (value / 5).alias("trip_distance"),
        (value * 0.8).alias("fare_amount"),
        value.alias("total_amount"),
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A: canonical trips from events, one scan."""
    rides = event_rides(spark, sf_dir)
    is_fhv = F.col("service_type") == "fhv"
    dropoff_lost = is_fhv & (F.col("event_id") % 5 == 0)
    measures = ("passenger_count", "trip_distance", "fare_amount", "total_amount")
    changed = {name: F.when(~is_fhv, F.col(name)) for name in measures}
    changed["do_location_id"] = F.when(~dropoff_lost, F.col("do_location_id"))
    return with_derived(_typed(rides.withColumns(changed)))


def event_service_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Fixture A as each service would report it: own headers, types and column sets."""
    rides = event_rides(spark, sf_dir)

    def of(service: str) -> DataFrame:
        return rides.filter(F.col("service_type") == service)

    measured = ["passenger_count", "trip_distance", "fare_amount", "total_amount"]
    yellow = of("yellow").select(
        "service_type",
        "event_id",
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
        F.col("pu_location_id").alias("PULocationID"),
        F.col("do_location_id").alias("DOLocationID"),
        *measured,
    )
    green = of("green").select(
        "event_id",
        F.col("passenger_count").cast("double").alias("passenger_count"),
        *measured[1:],
        F.col("pickup_datetime").alias("lpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("lpep_dropoff_datetime"),
        F.col("pu_location_id").cast("double").alias("PULocationID"),
        F.col("do_location_id").cast("double").alias("DOLocationID"),
        "service_type",
    )
    fhv = of("fhv").select(
        "service_type",
        "event_id",
        "pickup_datetime",
        F.col("dropoff_datetime").alias("dropOff_datetime"),
        F.col("pu_location_id").alias("PUlocationID"),
        F.when(F.col("event_id") % 5 != 0, F.col("do_location_id")).alias("DOlocationID"),
    )
    return {"yellow": yellow, "green": green, "fhv": fhv}


def shipped_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped rides from lineitem."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    service = F.lit(None).cast("string")
    for flag, name in FLAG_SERVICES.items():
        service = F.when(F.col("l_returnflag") == flag, F.lit(name)).otherwise(service)
    second_of_day = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 3571) % 86400
    pickup = _plus_seconds(F.col("l_shipdate"), second_of_day)
    price = F.col("l_extendedprice")
    return lines.select(
        service.alias("service_type"),
        pickup.alias("pickup_datetime"),
        _plus_seconds(pickup, F.col("l_quantity") * F.col("l_linenumber") * 60).alias("dropoff_datetime"),
        (F.col("l_suppkey") % 265 + 1).alias("pu_location_id"),
        (F.col("l_partkey") % 265 + 1).alias("do_location_id"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        (price * (1 - F.col("l_discount"))).alias("fare_amount"),
        price.alias("total_amount"),
    )


def shipped_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture B: canonical trips from lineitem, measures kept for all services."""
    return with_derived(_typed(shipped_rides(spark, sf_dir)))
