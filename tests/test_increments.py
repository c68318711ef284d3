"""Silver, partials and marts kept by month, against a full build after every change of the files."""

import datetime as dt
import os
import pathlib
import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kerbside.operators import marts, partials
from kerbside.plans import increments
from kerbside.plans.layers import load_trips
from kerbside.plans.months_kept import KeptTable, manifest_changes
from kerbside.settings import Lake

SPAN = (["green", "fhv"], "2024-01", "2024-06")
FULL = {
    "zone_hour_demand": marts.zone_hour_demand,
    "monthly_service_summary": marts.monthly_service_summary,
    "zone_hour_reliability": marts.zone_hour_reliability,
}


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "raw"), str(tmp_path / "out"))


def write(lake, month, seed, rows=60, service="green", strays=3):
    """A file of ``rows`` trips of its month and a few of the month after."""
    rng = random.Random(seed)
    days = [(month, rng.randint(1, 28)) for _ in range(rows)] + [(month % 12 + 1, 1)] * strays
    starts = [dt.datetime(2024, m, d, rng.randint(0, 23), rng.randint(0, 59)) for m, d in days]
    path = lake.month_path(service, 2024, month)
    pathlib.Path(path).parent.mkdir(parents=True, exist_ok=True)
    prefix = "lpep_" if service == "green" else ""
    columns = {
        f"{prefix}pickup_datetime": pa.array(starts, pa.timestamp("us")),
        f"{prefix}dropoff_datetime": pa.array([s + dt.timedelta(minutes=rng.randint(-1, 70)) for s in starts], pa.timestamp("us")),
        "PULocationID": pa.array([rng.choice([1, 2, 250, None]) for _ in starts], pa.int64()),
        "DOLocationID": pa.array([3] * len(starts), pa.int64()),
        "total_amount": pa.array([rng.randint(1, 90) / 2 for _ in starts]),
    }
    pq.write_table(pa.table(columns), path)
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def updated(spark, lake):
    changed = increments.update_silver(spark, lake, *SPAN)
    follow = increments.update_partials(spark, lake)
    assert all(sorted(found) == sorted(changed) for found in follow.values())
    return sorted(changed)


def assert_like_full_build(spark, lake):
    whole, _ = load_trips(spark, lake, *SPAN)
    kept = increments.read_kept_trips(spark, lake)
    if whole is None:
        assert kept.count() == 0
        whole = kept
    assert rows_of(kept) == rows_of(whole)
    for name, full in FULL.items():
        merged, wanted = increments.read_kept_mart(spark, lake, name), full(whole)
        assert merged.dtypes == wanted.dtypes and rows_of(merged) == rows_of(wanted), name


def test_equals_a_full_build_after_every_change(spark, lake, tmp_path):
    for month in (1, 2, 3):
        write(lake, month, month)
    write(lake, 2, 9, service="fhv")
    assert {c for *_, c in updated(spark, lake)} == {"added"}
    assert_like_full_build(spark, lake)
    assert updated(spark, lake) == []

    (tmp_path / "raw/2024/green_tripdata_2024-01.parquet").unlink()
    write(lake, 2, 22)
    write(lake, 5, 5)
    assert updated(spark, lake) == [("green", 2024, 1, "removed"), ("green", 2024, 2, "replaced"), ("green", 2024, 5, "added")]
    assert_like_full_build(spark, lake)
    written = {(r.service_type, r.src_month): r.written_in for r in increments.kept_silver(lake).manifest(spark).collect()}
    assert written == {("green", 2): 2, ("green", 3): 1, ("green", 5): 2, ("fhv", 2): 1}

    write(lake, 3, 3, rows=0, strays=0)
    assert updated(spark, lake) == [("green", 2024, 3, "replaced")]
    assert_like_full_build(spark, lake)

    for file in (tmp_path / "raw/2024").iterdir():
        file.unlink()
    assert {c for *_, c in updated(spark, lake)} == {"removed"}
    assert_like_full_build(spark, lake)


def test_unchanged_months_are_not_touched(spark, lake, tmp_path):
    write(lake, 1, 1)
    write(lake, 2, 2)
    updated(spark, lake)
    folder = tmp_path / "out/silver/trips_by_file/service_type=green/src_year=2024"
    before = {p: p.stat().st_mtime_ns for p in (folder / "src_month=1").iterdir()}
    write(lake, 2, 3)
    updated(spark, lake)
    assert {p: p.stat().st_mtime_ns for p in (folder / "src_month=1").iterdir()} == before


def test_a_run_that_ends_half_way_is_made_up_for(spark, lake, monkeypatch):
    write(lake, 1, 1)
    write(lake, 2, 2)
    updated(spark, lake)
    write(lake, 2, 3)
    gone = write(lake, 3, 4)

    def stop(*_args, **_kwargs):
        raise RuntimeError("the job was killed")

    with monkeypatch.context() as patch:
        patch.setattr("kerbside.plans.months_kept.save_parquet", stop)
        with pytest.raises(RuntimeError):
            increments.update_silver(spark, lake, *SPAN)
    # Written without a manifest, then withdrawn: the folder is nobody's.
    trips = increments.read_kept_trips(spark, lake, "src_year", "src_month").limit(0)
    trips.unionByName(increments.read_kept_trips(spark, lake, "src_year").selectExpr("*", "3 AS src_month")).write.mode(
        "append"
    ).partitionBy("service_type", "src_year", "src_month").parquet(increments.kept_silver(lake).root)
    os.remove(gone)
    assert updated(spark, lake) == [("green", 2024, 2, "replaced")]
    assert_like_full_build(spark, lake)


def test_partials_that_missed_an_update_catch_up(spark, lake):
    write(lake, 1, 1)
    updated(spark, lake)
    write(lake, 2, 2)
    increments.update_silver(spark, lake, *SPAN)
    write(lake, 3, 3)
    increments.update_silver(spark, lake, *SPAN)
    found = increments.update_partials(spark, lake)
    assert {tuple(sorted(c)) for c in found.values()} == {(("green", 2024, 2, "added"), ("green", 2024, 3, "added"))}
    assert_like_full_build(spark, lake)


def test_changes_of_manifests(spark):
    schema = "service_type string, src_year int, src_month int, made_from string"
    kept = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", 1, 3, "z")], schema)
    wanted = spark.createDataFrame([("a", 1, 1, "x"), ("a", 1, 2, "Y"), ("b", 1, 3, "z")], schema)
    assert rows_of(manifest_changes(kept, wanted)) == [("a", 1, 2, "replaced"), ("a", 1, 3, "removed"), ("b", 1, 3, "added")]


def test_months_are_read_by_folder(spark, lake):
    for month in (1, 2, 3):
        write(lake, month, month)
    updated(spark, lake)
    asked = increments.read_kept_trips(spark, lake, "src_year", "src_month").filter(increments.in_months([("green", 2024, 2)]))
    assert len(asked.inputFiles()) >= 1 and asked.select("src_month").distinct().collect()[0].src_month == 2
    plan = asked._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)", plan).group(1)
    assert "src_month" in filters and "Filter" not in plan.split("FileScan")[0]


def test_zone_sets_count_like_distinct(spark):
    rows = [("a", 2024, m, z) for m in range(1, 13) for z in (m % 5, 7, 40_000 + m, None)]
    trips = spark.createDataFrame(rows, "service_type string, year int, month int, pu_location_id int").selectExpr("*", "true AS valid_time")
    found = {r.quarter: r.unique_pu_zones for r in partials.zones_by_quarter(partials.zone_sets(trips)).collect()}
    assert found == {q: len({z for _, _, m, z in rows if (m + 2) // 3 == q and z is not None}) for q in range(1, 5)}


def test_reading_a_table_never_kept(spark, tmp_path):
    table = KeptTable(str(tmp_path / "none"))
    assert table.manifest(spark).count() == 0 and table.read(spark, "a int").count() == 0
    with pytest.raises(FileNotFoundError):
        table.read(spark)


def test_sketches_stay_within_their_rank_error(spark):
    trips = spark.range(60_000).selectExpr(
        "'a' AS service_type", "2024 AS year", "CAST(id % 12 + 1 AS INT) AS month", "true AS valid_time",
        "CAST(floor(14400 * pow(pmod(xxhash64(id), 10007) / 10007.0, 2)) AS DOUBLE) AS trip_duration_sec",
    )
    quantiles = partials.sketched_quantiles(partials.duration_sketches(trips), ["service_type"], (0.05, 0.5, 0.95))
    found = partials.rank_errors(quantiles, partials.duration_counts(trips), ["service_type"]).collect()
    assert {r.share for r in found} == {0.05, 0.5, 0.95} and all(r.rank_error <= partials.RANK_ERROR for r in found)
