import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbside.plans.layers import load_trips
from kerbside.settings import Lake
from kerbside.sources import months as M


def write_month(root, service, year, month, columns):
    folder = root / f"{year:04d}"
    folder.mkdir(exist_ok=True)
    pq.write_table(pa.table(columns), folder / f"{service}_tripdata_{year:04d}-{month:02d}.parquet")


def at(month, *minutes):
    times = [dt.datetime(2024, month, 3, 10) + dt.timedelta(minutes=m) for m in minutes]
    return pa.array(times, pa.timestamp("us"))


def fhv(month, zone_header, zone_type, pickup_header="pickup_datetime"):
    return {
        pickup_header: at(month, 0, 5),
        "dropOff_datetime": at(month, 10, 20),
        zone_header: pa.array([7, 8], zone_type),
        "DOlocationID": pa.array([1, None], pa.float64()),
    }


@pytest.fixture
def lake(tmp_path):
    return Lake(raw=str(tmp_path), out=str(tmp_path / "out"))


def test_spine_is_inclusive_and_crosses_years(spark):
    rows = [tuple(r) for r in M.month_spine(spark, "2023-11", "2024-02").collect()]
    assert rows == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    assert M.month_spine(spark).count() == 47
    assert M.month_spine(spark, "2024-02", "2024-01").count() == 0


def test_expected_and_missing(spark):
    expected = M.expected_months(spark, ["yellow", "fhv"], "2024-01", "2024-02")
    assert {tuple(r) for r in M.expected_file_counts(expected).collect()} == {("yellow", 2), ("fhv", 2)}
    landed = expected.filter("service_type = 'yellow'")
    assert {tuple(r) for r in M.missing_months(expected, landed).collect()} == {
        ("fhv", 2024, 1),
        ("fhv", 2024, 2),
    }


def test_header_case_and_type_drift_keeps_values(spark, tmp_path, lake):
    write_month(tmp_path, "fhv", 2024, 1, fhv(1, "PUlocationID", pa.int64()))
    write_month(tmp_path, "fhv", 2024, 2, fhv(2, "PULocationID", pa.float64(), "Pickup_datetime"))
    write_month(tmp_path, "fhv", 2024, 4, fhv(4, "PULOCATIONID", pa.int64()))
    loaded, report = load_trips(spark, lake, ["fhv"], "2024-01", "2024-04")
    got = {(r.month, r.pu_location_id, r.valid_time, r.valid_locations) for r in loaded.collect()}
    assert got == {(m, z, True, z == 7) for m in (1, 2, 4) for z in (7, 8)}
    assert [r.month for r in report.filter("NOT landed").collect()] == [3]


def test_one_scan_per_footer_variant(spark, tmp_path, lake):
    for month in (1, 2):
        write_month(tmp_path, "fhv", 2024, month, fhv(month, "PUlocationID", pa.int64()))
    write_month(tmp_path, "fhv", 2024, 3, fhv(3, "PULocationID", pa.int64()))
    write_month(tmp_path, "fhv", 2024, 4, fhv(4, "PULocationID", pa.float64()))
    found = M.probe_months(spark, lake, ["fhv"], "2024-01", "2024-04")
    assert len(M.scan_variants(spark, found)) == 2


def test_raw_union_keeps_provenance_and_all_columns(spark, tmp_path, lake):
    write_month(tmp_path, "fhv", 2024, 1, {**fhv(1, "PUlocationID", pa.int64()), "extra": [1, 2]})
    write_month(tmp_path, "fhv", 2024, 2, fhv(2, "PULocationID", pa.float64()))
    raw = M.load_service_raw(spark, lake, "fhv", "2024-01", "2024-02")
    rows = raw.groupBy("service_type", "src_year", "src_month").agg(
        F.count("PUlocationID").alias("zones"), F.count("extra").alias("extras")
    )
    assert {tuple(r) for r in rows.collect()} == {("fhv", 2024, 1, 2, 2), ("fhv", 2024, 2, 2, 0)}
    assert "void" not in dict(raw.dtypes).values()


def test_raw_by_service_leaves_out_services_without_files(spark, tmp_path, lake):
    write_month(tmp_path, "fhv", 2024, 1, fhv(1, "PUlocationID", pa.int64()))
    assert list(M.load_all_raw(spark, lake, ["yellow", "fhv"], "2024-01", "2024-01")) == ["fhv"]
    assert load_trips(spark, lake, ["yellow"], "2024-01", "2024-01")[0] is None


def test_corrupt_file_is_not_missing(spark, tmp_path, lake):
    folder = tmp_path / "2024"
    folder.mkdir()
    (folder / "fhv_tripdata_2024-01.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception) as raised:
        M.probe_months(spark, lake, ["fhv"], "2024-01", "2024-01")
    assert not (
        isinstance(raised.value, AnalysisException) and raised.value.getCondition() == "PATH_NOT_FOUND"
    )


def test_empty_month_file(spark, tmp_path, lake):
    empty = {name: column[:0] for name, column in fhv(1, "PUlocationID", pa.int64()).items()}
    write_month(tmp_path, "fhv", 2024, 1, empty)
    loaded, report = load_trips(spark, lake, ["fhv"], "2024-01", "2024-01")
    assert loaded.count() == 0 and report.first().landed


def test_stray_pickups_are_flagged_not_dropped(spark, tmp_path, lake):
    columns = fhv(1, "PUlocationID", pa.int64())
    pickups = [dt.datetime(2024, 1, 3, 10), dt.datetime(2008, 12, 31)]
    columns["pickup_datetime"] = pa.array(pickups, pa.timestamp("us"))
    write_month(tmp_path, "fhv", 2024, 1, columns)
    loaded, _ = load_trips(spark, lake, ["fhv"], "2024-01", "2024-01", flag_source_month=True)
    assert {(r.year, r.in_source_month) for r in loaded.collect()} == {(2024, True), (2008, False)}


def test_schema_probe(spark, tmp_path, lake):
    write_month(tmp_path, "fhv", 2024, 1, fhv(1, "PUlocationID", pa.int64()))
    schema, rows = M.probe_schema(spark, lake.month_path("fhv", 2024, 1))
    assert schema.names[0] == "pickup_datetime" and rows.count() == 2
    assert M.probe_schema(spark, lake.month_path("fhv", 2024, 2)) is None


def test_provenance_replaces_raw_columns_of_that_name(spark, tmp_path, lake):
    columns = {**fhv(1, "PUlocationID", pa.int64()), "Service_Type": ["x", "y"], "src_year": [1, 2]}
    write_month(tmp_path, "fhv", 2024, 1, columns)
    raw = M.load_service_raw(spark, lake, "fhv", "2024-01", "2024-01")
    rows = raw.select("service_type", "src_year", "src_month").distinct().collect()
    assert [tuple(r) for r in rows] == [("fhv", 2024, 1)]
