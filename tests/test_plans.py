"""The jobs end to end on small monthly files, and the shape of the plans they rely on."""

import contextlib
import datetime as dt
import io
import pathlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from kerbside.operators import features, insights, marts
from kerbside.plans import layers, subset
from kerbside.plans.forecasting import run_forecast
from kerbside.queries import all_queries, close_runs
from kerbside.settings import Lake
from kerbside.sources.months import spanned_months
from kerbside.sources.tables import read_trips, save_parquet

FIRST = dt.datetime(2024, 12, 10)


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    hours = [FIRST + dt.timedelta(hours=h) for h in range(24 * 40)]
    for month in {(t.year, t.month) for t in hours}:
        starts = [t for t in hours if (t.year, t.month) == month for _ in range(1 + t.hour % 3)]
        folder = root / f"{month[0]}"
        folder.mkdir(exist_ok=True)
        columns = {
            "lpep_pickup_datetime": pa.array(starts, pa.timestamp("us")),
            "lpep_dropoff_datetime": pa.array([t + dt.timedelta(minutes=9) for t in starts], pa.timestamp("us")),
            "PULocationID": pa.array([1 + i % 2 for i in range(len(starts))], pa.int64()),
            "DOLocationID": pa.array([3] * len(starts), pa.int64()),
            "total_amount": pa.array([8.0] * len(starts)),
        }
        pq.write_table(pa.table(columns), folder / f"green_tripdata_{month[0]}-{month[1]:02d}.parquet")
    return Lake(str(root), str(root / "out"))


@pytest.fixture(scope="module")
def silver(spark, lake):
    return layers.build_silver(spark, lake, start="2024-11", end="2025-02")


@pytest.fixture(scope="module")
def stored(spark, lake, silver):
    return layers.build_marts(spark, lake, silver)


def test_silver_modes(spark, lake, silver):
    assert silver.count() == 24 * 40 * 2
    assert layers.build_silver(spark, lake, "reuse").count() == silver.count()
    assert layers.build_silver(spark, lake, services=["yellow"], start="2024-12", end="2024-12") is None
    with pytest.raises(ValueError, match="Unknown mode"):
        layers.build_silver(spark, lake, "half")


def test_marts_add_up(silver, stored):
    valid = silver.filter("valid_time AND valid_locations").count()
    assert stored["zone_hour_demand"].groupBy().sum("pickups").first()[0] == valid
    assert stored["monthly_service_summary"].groupBy().sum("trips").first()[0] == silver.filter("valid_time").count()
    assert stored["zone_hour_reliability"].filter("share_long_trips NOT BETWEEN 0 AND 1").count() == 0


def test_subset_job(spark, lake):
    assert subset.load_subset(spark, lake) is None
    written = subset.make_subset(spark, lake, "2024-12", "green", 1)
    assert {r.pu_location_id for r in written.select("pu_location_id").distinct().collect()} == {1}
    assert subset.load_subset(spark, lake).count() == written.count()
    assert layers.build_silver(spark, lake, "subset").count() == written.count()
    assert subset.make_subset(spark, lake, "2020-01", "green", 1) is None


def test_null_zone_takes_a_place_but_no_rows(spark):
    from tests.trips import trips

    df = trips(spark, [{"pu": None}, {"pu": None}, {"pu": 4}, {"pu": 4}, {"pu": 4}, {"pu": 5}])
    assert {r.pu_location_id for r in subset.keep_busiest_zones(df, 2).collect()} == {4}


def test_forecast_run_stores_its_tables(spark, lake, stored):
    run = run_forecast(spark, lake, stored["zone_hour_demand"], max_depth=(2,), max_iter=(2,))
    assert {r.model for r in spark.read.parquet(lake.gold("model_metrics")).collect()} == {
        "baseline_lag24",
        "gbt_cv",
    }
    sample = spark.read.parquet(lake.gold("model_predictions"))
    assert sample.count() == run.predictions.count() and "features" not in sample.columns
    assert {"feat_year", "feat_month"} <= set(spark.read.parquet(lake.gold("model_features")).columns)


def test_timings_are_stored(spark, lake, stored):
    layers.record_timings(spark, lake, stored["zone_hour_demand"])
    assert spark.read.parquet(lake.gold("perf_timings")).count() == 2


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def test_marts_push_filters_and_prune(spark, lake, silver):
    text = plan(marts.zone_hour_reliability(read_trips(spark, lake.silver)), "formatted")
    assert "EqualTo(valid_time,true), EqualTo(valid_locations,true)" in text
    assert "fare_amount" not in text
    heat = plan(insights.demand_heatmap(read_trips(spark, lake.silver)), "formatted")
    assert "PartitionFilters: [isnotnull(service_type" in heat


@pytest.mark.parametrize("build", [marts.zone_hour_demand, marts.monthly_service_summary])
def test_hot_groups_are_spread_over_their_durations(silver, build):
    exchanges = [line for line in plan(build(silver)).splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert "trip_duration_sec" in exchanges[1] and "trip_duration_sec" not in exchanges[0]


def test_rebalanced_write_splits_a_hot_partition(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "200KB")
    try:
        rows = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 50 = 0, 'cold', 'hot') AS k", "id", "uuid() AS v")
        save_parquet(rows, str(tmp_path / "t"), ("k",), rebalance=True)
    finally:
        spark.conf.set(size, before)
    files = {k: len(list((tmp_path / "t" / f"k={k}").glob("*.parquet"))) for k in ("hot", "cold")}
    assert files["cold"] == 1 and files["hot"] >= 4


def test_silver_build_has_no_shuffle(spark, lake):
    loaded, _ = layers.load_trips(spark, lake, start="2024-11", end="2025-02")
    assert "Exchange" not in plan(loaded)


@pytest.mark.parametrize("densify", [False, True])
def test_features_need_one_exchange_of_the_mart(stored, densify):
    built = features.forecast_features(stored["zone_hour_demand"], None, densify=densify)
    assert plan(built).count("Exchange hashpartitioning") == 1


def test_top_zone_filter_is_a_broadcast_semi_join(stored):
    text = plan(features.keep_top_zones(stored["zone_hour_demand"], 50))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text and "TakeOrderedAndProject" in text


EAGER = (
    "loaded_months", "raw_provenance", "landing_report", "reencoded", "silver_roundtrip", "subset_job",
    "subset_fallback", "perf_timings", "cv_grid", "gbt_metrics", "gbt_predictions", "gbt_scored_rows",
    "dense_baselines", "gbt_zone_series", "feature_importances",
)


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(EAGER)))
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(all_queries()[name](spark, contract.ENTRY_DIR))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text, (name, operator)


def test_month_spine_is_lazy_and_empty_without_rows(spark):
    rows = spark.createDataFrame([], "at timestamp")
    assert spanned_months(rows, "at").count() == 0
    times = [(dt.datetime(2024, 11, 30),), (dt.datetime(2025, 2, 1),)]
    spine = spanned_months(spark.createDataFrame(times, "at timestamp"), "at", ["fhv"]).collect()
    assert [(r.year, r.month) for r in spine] == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]
    assert "parquet" in plan(all_queries()["month_spine"](spark, contract.ENTRY_DIR))


def test_closed_runs_leave_no_tables(spark):
    folder = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    session = spark.newSession()
    before = set(folder.iterdir())
    assert all_queries()["features_top_zones"](session, contract.ENTRY_DIR).count() > 0
    assert set(folder.iterdir()) - before
    close_runs(session)
    assert set(folder.iterdir()) == before


def test_subset_falls_back_to_the_month(spark, lake, tmp_path):
    empty = Lake(lake.raw, str(tmp_path / "out"))
    assert subset.load_subset(spark, empty) is None
    landed = subset.load_subset(spark, empty, "2024-12", "green")
    assert landed.count() == subset.one_month(spark, lake, "green", "2024-12").count()
