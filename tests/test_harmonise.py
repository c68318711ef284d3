import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbside.operators.harmonise import standardize, standardize_all
from kerbside.schema import TRIP_COLUMNS, TRIP_SCHEMA

NOON = dt.datetime(2024, 6, 2, 12, 0, 0)  # a Sunday


def yellow(spark, rows, pickup="tpep_pickup_datetime", dropoff="tpep_dropoff_datetime"):
    schema = (
        f"{pickup} timestamp_ntz, {dropoff} timestamp_ntz, PULocationID bigint, DOLocationID bigint, "
        "passenger_count double, trip_distance double, fare_amount double, total_amount double"
    )
    return spark.createDataFrame(rows, schema)


def ride(seconds=60, pickup=NOON, pu=1, do=2, passengers=1.0):
    dropoff = None if pickup is None or seconds is None else pickup + dt.timedelta(seconds=seconds)
    return (pickup, dropoff, pu, do, passengers, 1.5, 10.0, 12.5)


def test_schema_is_canonical(spark):
    trips = standardize(yellow(spark, [ride()]), "yellow")
    assert [(f.name, f.dataType) for f in trips.schema] == [(f.name, f.dataType) for f in TRIP_SCHEMA]


@pytest.mark.parametrize(
    ("seconds", "valid"), [(-60, False), (0, False), (1, True), (14_400, True), (14_401, False), (None, False)]
)
def test_duration_bounds(spark, seconds, valid):
    row = standardize(yellow(spark, [ride(seconds)]), "yellow").first()
    assert row.valid_time is valid
    assert row.trip_duration_sec == (None if seconds is None else float(seconds))


@pytest.mark.parametrize(("pu", "do", "valid"), [(1, 2, True), (None, 2, False), (1, None, False)])
def test_locations(spark, pu, do, valid):
    assert standardize(yellow(spark, [ride(pu=pu, do=do)]), "yellow").first().valid_locations is valid


def test_null_pickup_has_no_calendar_and_false_flags(spark):
    row = standardize(yellow(spark, [ride(pickup=None)]), "yellow").first()
    assert (row.year, row.hour, row.dow, row.valid_time) == (None, None, None, False)


def test_weekdays_start_on_sunday(spark):
    days = [ride(), ride(pickup=NOON + dt.timedelta(days=6))]
    got = standardize(yellow(spark, days), "yellow").select("dow", "year", "month", "day", "hour").collect()
    assert [tuple(r) for r in got] == [(1, 2024, 6, 2, 12), (7, 2024, 6, 8, 12)]


def test_header_case_and_plain_names(spark):
    cased = yellow(spark, [ride()], "TPEP_Pickup_DateTime", "Tpep_dropoff_datetime")
    plain = yellow(spark, [ride()], "pickup_datetime", "dropoff_datetime")
    stacked = standardize_all([("yellow", cased), ("yellow", plain)])
    assert stacked.distinct().count() == 1
    assert stacked.first().pickup_datetime == NOON


def test_specific_header_wins(spark):
    both = yellow(spark, [ride()]).withColumn("pickup_datetime", F.lit(None).cast("timestamp"))
    assert standardize(both, "yellow").first().pickup_datetime == NOON


def test_absent_columns_become_typed_nulls(spark):
    trips = standardize(yellow(spark, [ride()]).drop("fare_amount", "DOLocationID"), "yellow")
    row = trips.first()
    assert (row.fare_amount, row.do_location_id, row.valid_locations) == (None, None, False)
    assert dict(trips.dtypes)["fare_amount"] == "double"


def test_values_that_do_not_cast_become_null(spark):
    raw = yellow(spark, [ride(passengers=float("nan"))]).withColumn("trip_distance", F.lit("far"))
    row = standardize(raw, "yellow").first()
    assert (row.passenger_count, row.trip_distance) == (None, None)


def test_green_prefix(spark):
    raw = yellow(spark, [ride()], "lpep_pickup_datetime", "lpep_dropoff_datetime")
    row = standardize(raw, "green").first()
    assert (row.service_type, row.pickup_datetime, row.total_amount) == ("green", NOON, 12.5)


def test_fhv_measures_are_null_even_when_present(spark):
    raw = yellow(spark, [ride()], "Pickup_DateTime", "dropOff_datetime")
    row = standardize(raw.withColumnRenamed("PULocationID", "PUlocationID"), "fhv").first()
    assert (row.pu_location_id, row.trip_duration_sec) == (1, 60.0)
    assert (row.passenger_count, row.trip_distance, row.fare_amount, row.total_amount) == (None,) * 4


def test_unknown_service(spark):
    with pytest.raises(ValueError, match="Unknown service"):
        standardize(yellow(spark, [ride()]), "boat")


def test_empty_input(spark):
    trips = standardize(yellow(spark, []), "yellow")
    assert trips.columns == TRIP_COLUMNS and trips.count() == 0
