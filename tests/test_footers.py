import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kerbside.plans.layers import load_trips
from kerbside.plans.recode import MONTH_FOLDERS
from kerbside.settings import Lake
from kerbside.sources import footers
from kerbside.sources import months as M
from tests.test_months import fhv, write_month


def landed(spark, lake, *span):
    return footers.landed_files(spark, lake, ["fhv", "green"], *span)


def test_layouts_become_globs_and_patterns():
    glob, pattern, fields = footers.layout_parts(Lake("", "").month_layout)
    assert glob == "/*/*_tripdata_*-*.parquet" and fields == ["year", "service", "month"]
    name = "file:/lake/a b/2024/green_tripdata_2024-07.parquet"
    assert re.search(pattern, name).groups() == ("2024", "green", "07")
    assert not re.search(pattern, name.replace("_2024", "_2023"))
    glob, pattern, _ = footers.layout_parts(MONTH_FOLDERS)
    assert glob == "/month_file=*_tripdata_*-*.parquet"
    assert re.search(pattern, "s3://b/month_file=fhv_tripdata_2020-01.parquet/part-0.parquet").groups() == ("fhv", "2020", "01")
    assert footers.layout_parts("{root}/{service}/{month}.{year}.pq")[1].startswith(r"/([^/]+?)/(\d+)\.(\d+)\.pq")


def test_listing_takes_the_asked_months_only(spark, tmp_path):
    lake = Lake(str(tmp_path), str(tmp_path / "out"))
    assert landed(spark, lake, "2024-01", "2024-12").count() == 0
    for month in (1, 2, 12):
        write_month(tmp_path, "fhv", 2024, month, fhv(month, "PUlocationID", pa.int64()))
    write_month(tmp_path, "yellow", 2024, 2, fhv(2, "PUlocationID", pa.int64()))
    (tmp_path / "2024" / "notes.txt").write_text("not a month")
    rows = landed(spark, lake, "2024-02", "2024-12").collect()
    assert sorted((r.service_type, r.year, r.month) for r in rows) == [("fhv", 2024, 2), ("fhv", 2024, 12)]
    files = {r.path.removeprefix("file:"): r for r in rows}
    assert all(r.length == (tmp_path / path).stat().st_size and r.rows == 2 for path, r in files.items())


def test_variants_follow_names_and_types_not_case_or_order(spark, tmp_path):
    lake = Lake(str(tmp_path), str(tmp_path / "out"))
    columns = fhv(1, "PUlocationID", pa.int64())
    write_month(tmp_path, "fhv", 2024, 1, columns)
    write_month(tmp_path, "fhv", 2024, 2, dict(reversed(fhv(2, "PULOCATIONID", pa.int64()).items())))
    write_month(tmp_path, "fhv", 2024, 3, fhv(3, "PUlocationID", pa.float64()))
    write_month(tmp_path, "fhv", 2024, 4, {**fhv(4, "PUlocationID", pa.int64()), "more": [1, 2]})
    variant = {r.month: r.variant for r in landed(spark, lake, "2024-01", "2024-04").collect()}
    assert variant[1] == variant[2] and len(set(variant.values())) == 3


def test_long_footers_and_damaged_files(tmp_path):
    wide = tmp_path / "wide.parquet"
    pq.write_table(pa.table({f"column_{i:05d}": [i] for i in range(4_000)}), wide)
    variant, digest, rows = footers.read_footer(f"file:{wide}")
    length = int.from_bytes(wide.read_bytes()[-8:-4], "little")
    assert length > footers._TAIL_BYTES and rows == 1 and len(variant) == len(digest) == 64
    for content in (b"", b"PAR1", b"x" * 50, wide.read_bytes()[-50:]):
        broken = tmp_path / "broken.parquet"
        broken.write_bytes(content)
        with pytest.raises(Exception, match="not a parquet|Parquet|thrift"):
            footers.read_footer(f"file:{broken}")


def test_stores_that_only_spark_reads_give_the_same_variants(spark, tmp_path):
    lake = Lake(str(tmp_path), str(tmp_path / "out"))
    write_month(tmp_path, "fhv", 2024, 1, fhv(1, "PUlocationID", pa.int64()))
    write_month(tmp_path, "fhv", 2024, 2, fhv(2, "PULOCATIONID", pa.int64()))
    write_month(tmp_path, "fhv", 2024, 3, fhv(3, "PUlocationID", pa.float64()))
    files = footers.listed_files(spark, lake, ["fhv"], "2024-01", "2024-03")
    slow = {r.month: r.variant for r in footers._with_spark_schemas(spark, files).collect()}
    assert slow[1] == slow[2] != slow[3]


def jobs_of(spark, work):
    spark.sparkContext.setJobGroup("counted", "counted")
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    work()
    return len(set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before)


def test_jobs_do_not_follow_the_number_of_files(spark, tmp_path):
    counts = []
    for name, months in (("few", 2), ("many", 24)):
        root = tmp_path / name
        root.mkdir()
        lake = Lake(str(root), str(root / "out"))
        for i in range(months):
            write_month(root, "fhv", 2020 + i // 12, i % 12 + 1, fhv(1, "PUlocationID", pa.int64()))
        counts.append(jobs_of(spark, lambda lake=lake: load_trips(spark, lake, ["fhv"], "2020-01", "2022-12")))
    assert counts[0] == counts[1] <= 4


def test_a_month_folder_may_hold_files_of_two_variants(spark, tmp_path):
    folder = tmp_path / "month_file=fhv_tripdata_2024-01.parquet"
    folder.mkdir()
    for i, kind in enumerate((pa.int64(), pa.float64())):
        pq.write_table(pa.table(fhv(1, "PUlocationID", kind)), folder / f"part-{i}.parquet")
    lake = Lake(str(tmp_path), str(tmp_path / "out"), MONTH_FOLDERS)
    trips, report = load_trips(spark, lake, ["fhv"], "2024-01", "2024-01")
    assert sorted(r.pu_location_id for r in trips.collect()) == [7, 7, 8, 8] and report.first().landed
    columns = M.month_columns(spark, M.probe_months(spark, lake, ["fhv"], "2024-01", "2024-02"))
    assert {r.data_type for r in columns.filter("column_name = 'PUlocationID'").collect()} == {"bigint", "double"}
