"""Raw months of the deliveries: variants written side by side, and the month that a path names."""

import threading

import pytest

from kerbside import queries
from kerbside.sources.months import _month_part


def test_variants_are_written_side_by_side(spark, monkeypatch):
    together = threading.Barrier(5, timeout=30)
    written = []

    def write(raw, root, service, *_):
        together.wait()
        written.append(service)

    monkeypatch.setattr(queries, "write_months", write)
    columns = "pu_location_id, do_location_id, passenger_count, trip_distance, fare_amount, total_amount"
    rides = spark.range(0).selectExpr(
        "'fhv' AS service_type", "1 AS y", "1 AS m", "now() AS pickup_datetime", "now() AS dropoff_datetime",
        *[f"1 AS {c}" for c in columns.split(", ")],
    )
    queries._write_raw_months(rides, "nowhere")
    assert sorted(written) == ["fhv", "fhv", "green", "yellow", "yellow"]


@pytest.mark.parametrize(
    "path",
    [
        "file:/a/2024/green_tripdata_2024-03.parquet",
        "file:/a/month_file=green_tripdata_2024-03.parquet/part-0.parquet",
        "file:/a_tripdata_1999-01/fhv_tripdata_2024-03.parquet",
        "file:/a/fhv_tripdata_2024-03.parquet/x_tripdata_part-0.parquet",
    ],
)
def test_month_of_a_path(spark, path):
    rows = spark.createDataFrame([(path,)], "path string")
    assert tuple(rows.select(_month_part("path", 1), _month_part("path", 2)).first()) == (2024, 3)


def test_a_path_without_a_month_ends_the_read(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("file:/a/b.parquet",)], "path string").select(_month_part("path", 1)).collect()
