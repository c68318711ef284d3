"""The canonical trip schema and, per service, where its columns come from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("service_type", T.StringType(), False),
        T.StructField("pickup_datetime", T.TimestampType()),
        T.StructField("dropoff_datetime", T.TimestampType()),
        T.StructField("pu_location_id", T.IntegerType()),
        T.StructField("do_location_id", T.IntegerType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("dow", T.IntegerType()),
        T.StructField("trip_duration_sec", T.DoubleType()),
        T.StructField("valid_time", T.BooleanType(), False),
        T.StructField("valid_locations", T.BooleanType(), False),
    ]
)
TRIP_COLUMNS = TRIP_SCHEMA.names
MEASURES = ("passenger_count", "trip_distance", "fare_amount", "total_amount")

# Columns read from the raw file, in canonical order; the rest are derived.
_RAW_BACKED = TRIP_COLUMNS[1:9]


@dataclass(frozen=True)
class ServiceColumns:
    """Raw header candidates, first match wins, case ignored. No candidates: always null."""

    candidates: dict[str, tuple[str, ...]]

    def for_column(self, canonical: str) -> tuple[str, ...]:
        return self.candidates.get(canonical, ())


_ZONES = {
    "pu_location_id": ("PULocationID", "pu_location_id"),
    "do_location_id": ("DOLocationID", "do_location_id"),
}
_MEASURES = {name: (name,) for name in MEASURES}

# The headers of the three services; fhv reports no measures.
SERVICE_COLUMNS = {
    "yellow": ServiceColumns(
        {
            "pickup_datetime": ("tpep_pickup_datetime", "pickup_datetime"),
            "dropoff_datetime": ("tpep_dropoff_datetime", "dropoff_datetime"),
            **_ZONES,
            **_MEASURES,
        }
    ),
    "green": ServiceColumns(
        {
            "pickup_datetime": ("lpep_pickup_datetime", "pickup_datetime"),
            "dropoff_datetime": ("lpep_dropoff_datetime", "dropoff_datetime"),
            **_ZONES,
            **_MEASURES,
        }
    ),
    "fhv": ServiceColumns(
        {"pickup_datetime": ("pickup_datetime",), "dropoff_datetime": ("dropoff_datetime",), **_ZONES}
    ),
}


def raw_backed_fields() -> list[T.StructField]:
    return [TRIP_SCHEMA[name] for name in _RAW_BACKED]
