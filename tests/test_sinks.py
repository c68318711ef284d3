import datetime as dt
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from kerbside.operators import marts
from kerbside.plans import recode
from kerbside.settings import Lake
from kerbside.sources import jdbc
from kerbside.sources.months import load_service_raw, probe_months
from kerbside.sources.tables import read_trips, save_parquet
from tests.trips import START, demand, trips

ENV = {"PG_HOST": "db", "PG_DB": "taxi", "PG_USER": "u", "PG_PASSWORD": "p"}


@pytest.fixture
def writes(monkeypatch):
    seen = []

    def record(self, url, table, mode=None, properties=None):
        seen.append((url, table, mode, properties, self._df))

    monkeypatch.setattr(DataFrameWriter, "jdbc", record)
    return seen


@pytest.mark.parametrize("missing", sorted(ENV))
def test_export_is_skipped_without_target(spark, writes, missing):
    env = {k: v for k, v in ENV.items() if k != missing}
    assert jdbc.export_table(spark.range(1), "t", env=env) is False
    assert writes == []


def test_export_passes_target(spark, writes):
    assert jdbc.export_table(spark.range(1), "t", "append", ENV) is True
    url, table, mode, properties, _ = writes[0]
    assert (url, table, mode) == ("jdbc:postgresql://db:5432/taxi", "t", "append")
    assert (properties["user"], properties["password"]) == ("u", "p")
    assert jdbc.target_from_env({**ENV, "PG_PORT": "6000"})[0] == "jdbc:postgresql://db:6000/taxi"


def test_export_curated_set(spark, writes):
    rows = [("yellow", 1, 0, 5), ("yellow", 1, 24 * 31, 6)]
    small = [spark.range(n) for n in (1, 2, 3)]
    outcome = jdbc.export_curated(*small, jdbc.year_slice(demand(spark, rows)), prefix="x_", env=ENV)
    assert "x_zone_hour_demand_2025" in outcome
    assert list(outcome.values()) == [True] * 4 and list(outcome) == [w[1] for w in writes]
    assert [r.ts_hour for r in writes[-1][4].collect()] == [START + dt.timedelta(days=31)]
    jdbc.export_curated(*small, demand(spark, rows), env=ENV, year=2024)
    assert writes[-1][1] == "zone_hour_demand_2024" and writes[-1][4].count() == 2
    assert len(jdbc.export_curated(spark.range(1), spark.range(1), spark.range(1), env={})) == 3


def test_trips_survive_partitioned_storage(spark, tmp_path):
    df = trips(spark, [{}, {"at": None}, {"service": "fhv", "pu": None}])
    save_parquet(df, str(tmp_path / "silver"), ("service_type", "year", "month"), rebalance=True)
    stored = read_trips(spark, str(tmp_path / "silver"))
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in df.schema]
    assert stored.exceptAll(df).count() == 0 and stored.count() == 3


def test_rebalanced_mart_without_partitions(spark, tmp_path):
    mart = marts.monthly_service_summary(trips(spark, [{}, {"service": "fhv"}]))
    save_parquet(mart, str(tmp_path / "monthly"), rebalance=True)
    assert spark.read.parquet(str(tmp_path / "monthly")).count() == 2


def test_modes_and_codec(spark, tmp_path):
    path = tmp_path / "t"
    save_parquet(spark.range(3), str(path), compression="gzip")
    save_parquet(spark.range(2), str(path), mode="append", compression="gzip")
    assert spark.read.parquet(str(path)).count() == 5
    save_parquet(spark.range(1), str(path))
    assert spark.read.parquet(str(path)).count() == 1


def codecs(root):
    files = Path(root).rglob("*.parquet")
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if f.is_file()}


def test_recode_changes_only_the_codec(spark, tmp_path):
    (tmp_path / "2024").mkdir()
    for month, header in ((1, "PUlocationID"), (2, "PULocationID"), (3, "PULocationID")):
        frame = spark.createDataFrame([(START, month)], f"pickup_datetime timestamp_ntz, {header} bigint")
        table = frame.toArrow()
        pq.write_table(table, tmp_path / "2024" / f"fhv_tripdata_2024-{month:02d}.parquet", compression="zstd")
    lake = Lake(str(tmp_path), str(tmp_path / "out"))
    span = ("2024-01", "2024-04")
    recoded = recode.recode_months(spark, lake, str(tmp_path / "snappy"), "snappy", ["fhv"], *span)
    assert codecs(tmp_path / "2024") == {"ZSTD"} and codecs(tmp_path / "snappy") == {"SNAPPY"}
    before, after = (load_service_raw(spark, place, "fhv", *span) for place in (lake, recoded))
    assert before.dtypes == after.dtypes
    assert before.exceptAll(after).count() == 0 and after.count() == 3
    again = recode.recode_months(spark, lake, str(tmp_path / "snappy"), "snappy", ["fhv"], *span)
    assert load_service_raw(spark, again, "fhv", *span).count() == 3


def written_months(root, months=(1, 2, 3)):
    (root / "2024").mkdir(parents=True)
    for month in months:
        columns = {"pickup_datetime": [START] * 4, "PULocationID": [month, 2, 2, None], "fare_amount": [1.0, 2.5, 2.5, None]}
        pq.write_table(pa.table(columns), root / "2024" / f"fhv_tripdata_2024-{month:02d}.parquet", compression="zstd")


def test_only_months_proven_equal_are_adopted(spark, tmp_path):
    written_months(tmp_path / "raw")
    lake, span = Lake(str(tmp_path / "raw"), str(tmp_path / "out")), (["fhv"], "2024-01", "2024-06")
    staged = recode.recode_months(spark, lake, str(tmp_path / "staged"), "snappy", *span)
    path = Path(staged.month_path("fhv", 2024, 2))
    rows = spark.read.parquet(str(path)).toArrow()
    for part in path.glob("*"):
        part.unlink()
    # As many rows, another value; a repeated row in place of another one.
    pq.write_table(rows.take([0, 1, 1, 1]), path / "part-0.parquet")
    target = tmp_path / "target"
    adopted, proof = recode.adopt_proven(spark, lake, staged, str(target), *span)
    assert {(r.month, r.rows_before, r.rows_after, r.equal) for r in proof.collect()} == {
        (1, 4, 4, True), (2, 4, 4, False), (3, 4, 4, True),
    }
    assert {p.name[-18:-8] for p in target.iterdir()} == {"ta_2024-01", "ta_2024-03"} and path.exists()
    assert codecs(target) == {"SNAPPY"}


def test_proof_sees_columns_and_missing_months(spark, tmp_path):
    written_months(tmp_path / "a")
    written_months(tmp_path / "b", (1, 2))
    renamed = tmp_path / "b/2024/fhv_tripdata_2024-02.parquet"
    table = pq.read_table(renamed)
    pq.write_table(table.rename_columns(["pickup_datetime", "DOLocationID", "fare_amount"]), renamed)
    sides = [
        recode.month_digests(spark, probe_months(spark, Lake(str(tmp_path / side), ""), ["fhv"], "2024-01", "2024-03")) for side in "ab"
    ]
    assert {r.month: r.equal for r in recode.recode_proof(*sides).collect()} == {1: True, 2: False, 3: False}
    assert recode.month_digests(spark, []).count() == 0


def test_recode_proven_replaces_what_the_target_had(spark, tmp_path):
    written_months(tmp_path / "raw")
    lake, span = Lake(str(tmp_path / "raw"), str(tmp_path / "out")), (["fhv"], "2024-01", "2024-03")
    for _ in range(2):
        adopted, proof = recode.recode_proven(spark, lake, str(tmp_path / "target"), "snappy", *span)
        assert proof.filter("equal").count() == 3
        assert load_service_raw(spark, adopted, "fhv", *span[1:]).count() == 12
