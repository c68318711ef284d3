"""The registered queries. Each takes (spark, sf_dir) and runs over whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside import proxies
from kerbside.operators import features, forecast, harmonise, insights, marts, partials, profile, timing
from kerbside.plans import increments
from kerbside.plans.forecasting import ForecastRun, fit_and_score
from kerbside.plans.layers import load_trips
from kerbside.plans.recode import MONTH_FOLDERS, adopt_proven, recode_months, write_months
from kerbside.plans.subset import keep_busiest_zones, load_subset, make_sized_subset, make_subset
from kerbside.session import Workspace, pin_timezone, remove_path
from kerbside.settings import AIRPORT_ZONES, END_MONTH, MIDTOWN_ZONES, SERVICES, START_MONTH, Lake
from kerbside.sources import months as M
from kerbside.sources.jdbc import year_slice
from kerbside.sources.tables import read_trips, save_parquet

Query = Callable[[SparkSession, str], DataFrame]

# Group sizes of the fixtures differ from city data, so these queries pass their own parameters.
TREND_MIN_TRIPS = 200
TOP_ZONES = 5
SUBSET = {"service": "green", "year": 2024, "month": 12, "zones": 3}
RAW_RANGE = ("1994-01", "2002-12")
LAGS_WITH_SEASONAL = (1, 23, 24, 168)
SUBSET_MONTH = {"month": "1995-06", "service": "green"}
SAMPLE_BYTES = 250_000
SAMPLE_ROWS = 500
DAMAGED = ("green", 1997, 3)
DENSE_MONTHS = ("2024-12", "2025-01")
# What the second delivery of monthly files brings: months from here on, these months corrected, those withdrawn.
LATE_FROM, CORRECTED, WITHDRAWN = 2001, ("green", 1996), ("fhv", 1998)

_REGISTRY: dict[str, Query] = {}
_RUNS: WeakKeyDictionary[SparkSession, dict[str, QueryRun]] = WeakKeyDictionary()


class QueryRun:
    """What several queries over one input share: stored copies and the fitted model, built once.

    ``close`` removes the tables. Inputs are taken to stay as they are until then.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.work = Workspace(spark, "queries")
        self._built: dict[str, object] = {}

    def once(self, name: str, build: Callable[[], object]):
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def close(self) -> None:
        self._built.clear()
        self.work.close()


def run_over(spark: SparkSession, sf_dir: str) -> QueryRun:
    runs = _RUNS.setdefault(spark, {})
    if sf_dir not in runs:
        runs[sf_dir] = QueryRun(spark, sf_dir)
    return runs[sf_dir]


def close_runs(spark: SparkSession) -> None:
    """Forget and remove what queries of this session have stored."""
    for run in _RUNS.pop(spark, {}).values():
        run.close()


def query(fn: Query) -> Query:
    """Register under the function's name; times leave as wall-clock values, doubles to 6 digits."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(fn(pin_timezone(spark), sf_dir))

    _REGISTRY[fn.__name__] = run
    return fn


def presented(df: DataFrame) -> DataFrame:
    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            # Twice: the first takes out the noise of summation order, which could tip a tie.
            value = F.round(F.round(value, 10), 6)
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        return value.alias(field.name)

    return df.select(*[column(field) for field in df.schema.fields])


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.zone_hour_demand(proxies.event_trips(spark, sf_dir))


def _stored_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = run_over(spark, sf_dir)
    return run.once("demand", lambda: run.work.store(_demand(spark, sf_dir), "demand"))


def _reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.zone_hour_reliability(proxies.event_trips(spark, sf_dir))


# Trips and their quality


@query
def canonical_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonise.standardize_all(proxies.event_service_frames(spark, sf_dir).items())


@query
def service_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.union_aligned(proxies.event_service_frames(spark, sf_dir).values())


@query
def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_over(spark, sf_dir).work.path("silver")
    trips = proxies.event_trips(spark, sf_dir)
    save_parquet(trips, path, ("service_type", "year", "month"), rebalance=True)
    return read_trips(spark, path)


@query
def quality_flags_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.quality_overview(proxies.event_trips(spark, sf_dir))


@query
def trips_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rows_by_service(proxies.event_trips(spark, sf_dir))


@query
def zone_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.zone_profile(proxies.event_trips(spark, sf_dir))


@query
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(proxies.event_trips(spark, sf_dir))


# Marts


@query
def zone_hour_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _demand(spark, sf_dir)


@query
def zone_hour_demand_2025(spark: SparkSession, sf_dir: str) -> DataFrame:
    return year_slice(_demand(spark, sf_dir))


@query
def monthly_service_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.monthly_service_summary(proxies.shipped_trips(spark, sf_dir))


@query
def zone_hour_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reliability(spark, sf_dir)


@query
def bench_mart_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timing.demand_by_zone(_demand(spark, sf_dir))


@query
def perf_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timing.time_cached_and_uncached(spark, _stored_demand(spark, sf_dir))


# Insights


@query
def demand_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.demand_heatmap(proxies.event_trips(spark, sf_dir))


@query
def demand_heatmap_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = insights.heatmap_grid(insights.demand_heatmap(proxies.event_trips(spark, sf_dir)))
    return grid.select("dow", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in range(24)])


@query
def monthly_trend_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = marts.monthly_service_summary(proxies.shipped_trips(spark, sf_dir))
    return insights.monthly_trend(monthly, TREND_MIN_TRIPS)


@query
def h3_airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.long_share_by_zone(_reliability(spark, sf_dir), AIRPORT_ZONES)


@query
def h3_midtown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.long_share_by_zone(_reliability(spark, sf_dir), MIDTOWN_ZONES)


@query
def zone_group_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.zone_group_quartiles(_reliability(spark, sf_dir))


@query
def zone_group_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.zone_group_boxes(_reliability(spark, sf_dir))


@query
def zone_group_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.zone_group_outliers(_reliability(spark, sf_dir))


@query
def airport_rank_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether trips from airports last longer than those from Midtown."""
    return insights.duration_rank_test(proxies.event_trips(spark, sf_dir), run_over(spark, sf_dir).work)


@query
def top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.top_zones(_demand(spark, sf_dir), TOP_ZONES)


@query
def subset_top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = (
        (F.col("service_type") == SUBSET["service"])
        & (F.col("year") == SUBSET["year"])
        & (F.col("month") == SUBSET["month"])
    )
    return keep_busiest_zones(proxies.event_trips(spark, sf_dir).filter(chosen), SUBSET["zones"])


@query
def sized_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored sample of a given size."""
    lake = Lake(raw="", out=run_over(spark, sf_dir).work.path("sized"))
    return make_sized_subset(spark, lake, proxies.event_trips(spark, sf_dir), SAMPLE_BYTES)


# Monthly files


def _landed(trips: DataFrame) -> DataFrame:
    return trips.select("service_type", "year", "month").distinct()


@query
def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service-months between the first and the last trip."""
    return M.spanned_months(proxies.shipped_trips(spark, sf_dir), "pickup_datetime")


@query
def expected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.expected_file_counts(month_spine(spark, sf_dir))


@query
def missing_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured months without an event trip."""
    expected = M.expected_months(spark, SERVICES, START_MONTH, END_MONTH)
    return M.missing_months(expected, _landed(proxies.event_trips(spark, sf_dir)))


def _ride_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxies.shipped_rides(spark, sf_dir).select(
        "*", F.year("pickup_datetime").alias("y"), F.month("pickup_datetime").alias("m")
    )


def _write_raw_months(rides: DataFrame, root: str) -> None:
    """Lineitem rides as monthly files whose headers, types and columns drift by year.

    No two variants share a month, so they are written side by side.
    """
    even = F.col("y") % 2 == 0
    double_ids = {c: F.col(c).cast("double") for c in ("pu_location_id", "do_location_id", "passenger_count")}
    zones = {"pu_location_id": "PULocationID", "do_location_id": "DOLocationID"}
    fhv_zones = {"pu_location_id": "PUlocationID", "do_location_id": "DOlocationID"}
    measured = ("passenger_count", "trip_distance", "fare_amount", "total_amount")
    variants = [
        ("yellow", even, {}, {**_times("tpep_pickup_datetime", "tpep_dropoff_datetime"), **zones}, ()),
        (
            "yellow",
            ~even,
            double_ids,
            {**_times("Tpep_Pickup_Datetime", "Tpep_Dropoff_Datetime"), **zones},
            ("fare_amount",),
        ),
        ("green", F.lit(True), {}, {**_times("lpep_pickup_datetime", "lpep_dropoff_datetime"), **zones}, ()),
        ("fhv", even, {}, {**_times("pickup_datetime", "dropOff_datetime"), **fhv_zones}, measured),
        ("fhv", ~even, double_ids, {**_times("Pickup_datetime", "DropOff_datetime"), **zones}, measured),
    ]

    def write(variant: tuple) -> None:
        service, years, retyped, renamed, dropped = variant
        raw = (
            rides.filter((F.col("service_type") == service) & years)
            .withColumns(retyped)
            .withColumnsRenamed(renamed)
            .drop(*dropped)
        )
        write_months(raw, root, service, "y", "m", "zstd")

    with ThreadPoolExecutor(len(variants)) as pool:
        list(pool.map(write, variants))


def _times(pickup: str, dropoff: str) -> dict[str, str]:
    return {"pickup_datetime": pickup, "dropoff_datetime": dropoff}


def _new_lake(run: QueryRun, name: str) -> Lake:
    return Lake(raw=run.work.path(f"{name}-raw"), out=run.work.path(f"{name}-out"), month_layout=MONTH_FOLDERS)


def _raw_months(spark: SparkSession, sf_dir: str) -> Lake:
    run = run_over(spark, sf_dir)

    def build() -> Lake:
        lake = _new_lake(run, "months")
        _write_raw_months(_ride_months(spark, sf_dir), lake.raw)
        return lake

    return run.once("months", build)


def _month_totals(trips: DataFrame, *extra) -> DataFrame:
    return trips.groupBy("service_type", "year", "month").agg(
        F.count("*").alias("trips"),
        F.count_if("valid_time").alias("valid_trips"),
        F.sum("trip_duration_sec").alias("duration_sec"),
        F.sum("pu_location_id").alias("pu_sum"),
        F.sum("passenger_count").alias("passengers"),
        F.round(F.sum("fare_amount"), 4).alias("fares"),
        F.round(F.sum("total_amount"), 4).alias("amount"),
        *extra,
    )


@query
def loaded_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per month of drifting files, read back through the loader."""
    trips, _ = load_trips(spark, _raw_months(spark, sf_dir), SERVICES, *RAW_RANGE, flag_source_month=True)
    return _month_totals(trips, F.count_if("in_source_month").alias("in_source_month"))


@query
def raw_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per service and file month of the raw frames."""
    raw = M.load_all_raw(spark, _raw_months(spark, sf_dir), SERVICES, *RAW_RANGE)
    return M.union_aligned(raw.values()).groupBy("service_type", "src_year", "src_month").agg(
        F.count("*").alias("rows")
    )


@query
def landing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected service-months and whether their file is there."""
    return M.month_report(spark, M.probe_months(spark, _raw_months(spark, sf_dir), SERVICES, *RAW_RANGE))


@query
def probed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw columns and types of every landed month, as its footer has them."""
    return M.month_columns(spark, M.probe_months(spark, _raw_months(spark, sf_dir), SERVICES, *RAW_RANGE))


@query
def reencoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same totals after rewriting the files with another codec."""
    source = _raw_months(spark, sf_dir)
    recoded = recode_months(
        spark, source, run_over(spark, sf_dir).work.path("recoded"), "snappy", SERVICES, *RAW_RANGE
    )
    trips, _ = load_trips(spark, recoded, SERVICES, *RAW_RANGE)
    return _month_totals(trips)


@query
def recode_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-encoded months, one of them damaged before the proof: which are equal, and which were adopted."""
    source, work = _raw_months(spark, sf_dir), run_over(spark, sf_dir).work
    staged = recode_months(spark, source, work.path("staged"), "snappy", SERVICES, *RAW_RANGE)
    path = staged.month_path(*DAMAGED)
    rows = work.store(spark.read.parquet(path).withColumn("fare_amount", F.col("fare_amount") + 1), "damaged")
    rows.write.mode("overwrite").parquet(path)
    adopted, proof = adopt_proven(spark, source, staged, work.path("adopted"), SERVICES, *RAW_RANGE)
    landed = M.month_report(spark, M.probe_months(spark, adopted, SERVICES, *RAW_RANGE))
    return proof.join(landed, ["service_type", "year", "month"]).withColumnRenamed("landed", "adopted")


@query
def subset_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored subset of one landed month: written by the job, read back by the loader."""
    lake = _raw_months(spark, sf_dir)
    lake = replace(lake, out=run_over(spark, sf_dir).work.path("subset"))
    make_subset(spark, lake, **SUBSET_MONTH, max_zones=SUBSET["zones"])
    return load_subset(spark, lake, **SUBSET_MONTH)


@query
def subset_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed month itself where no subset is stored."""
    lake = _raw_months(spark, sf_dir)
    return load_subset(spark, replace(lake, out=run_over(spark, sf_dir).work.path("no-subset")), **SUBSET_MONTH)


# Tables kept up to date by month


def _of(chosen: tuple[str, int]):
    return (F.col("service_type") == chosen[0]) & (F.col("y") == chosen[1])


def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[Lake, list[tuple[str, int, int, str]]]:
    """A lake after two deliveries of monthly files, silver and partials updated after each; and what the second changed."""
    run = run_over(spark, sf_dir)

    def build():
        lake, rides = _new_lake(run, "deliveries"), _ride_months(spark, sf_dir)
        wrong = {"pu_location_id": F.lit(1).cast("bigint"), "total_amount": F.col("total_amount") * 2}
        early = rides.filter(F.col("y") < LATE_FROM)
        mended = {name: F.when(_of(CORRECTED), value).otherwise(F.col(name)) for name, value in wrong.items()}
        _write_raw_months(early.withColumns(mended), lake.raw)
        span = (SERVICES, *RAW_RANGE)
        increments.update_silver(spark, lake, *span)
        increments.update_partials(spark, lake)
        late = run.work.store(rides.filter((F.col("y") >= LATE_FROM) | _of(CORRECTED)), "late")
        _write_raw_months(late, lake.raw)
        run.work.drop(late)
        service, year = WITHDRAWN
        for month in range(1, 13):
            remove_path(spark, lake.month_path(service, year, month))
        changed = increments.update_silver(spark, lake, *span)
        increments.update_partials(spark, lake)
        return lake, changed

    return run.once("deliveries", build)


@query
def silver_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second delivery changed, as the update found it."""
    _, changed = _deliveries(spark, sf_dir)
    return spark.createDataFrame(changed, "service_type string, src_year int, src_month int, change string")


@query
def silver_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per month of the kept trips, and which update wrote the month: unchanged months stay as first written."""
    lake, _ = _deliveries(spark, sf_dir)
    months = increments.kept_silver(lake).manifest(spark).select(
        "service_type",
        F.col("src_year").alias("year"),
        F.col("src_month").alias("month"),
        F.col("rows").alias("manifest_rows"),
        "written_in",
    )
    return _month_totals(increments.read_kept_trips(spark, lake)).join(months, ["service_type", "year", "month"], "full")


@query
def kept_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demand mart merged from stored counts per source month."""
    return increments.read_kept_mart(spark, _deliveries(spark, sf_dir)[0], "zone_hour_demand")


@query
def kept_monthly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increments.read_kept_mart(spark, _deliveries(spark, sf_dir)[0], "monthly_service_summary")


@query
def kept_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increments.read_kept_mart(spark, _deliveries(spark, sf_dir)[0], "zone_hour_reliability")


@query
def zones_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different pickup zones per quarter, from the stored bitmaps of the months."""
    return partials.zones_by_quarter(increments.read_partial(spark, _deliveries(spark, sf_dir)[0], "zone_sets"))


@query
def sketched_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether yearly quantiles from merged monthly sketches keep their bound on the rank error."""
    lake, _ = _deliveries(spark, sf_dir)
    keys = ["service_type", "year"]
    quantiles = partials.sketched_quantiles(increments.read_partial(spark, lake, "duration_sketches"), keys, (0.5, 0.95))
    counts = increments.read_partial(spark, lake, "duration_counts")
    found = partials.rank_errors(quantiles, counts, keys)
    return found.select(*keys, "share", (F.col("rank_error") <= partials.RANK_ERROR).alias("within_bound"))


# Features


@query
def features_top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.keep_top_zones(_stored_demand(spark, sf_dir), TOP_ZONES)


@query
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = features.series_window("service_zone")
    return _demand(spark, sf_dir).select(
        "service_type",
        "zone_id",
        "ts_hour",
        "pickups",
        *features.lag_columns(window, features.LAGS),
        F.lead("pickups", 1).over(window).alias("label"),
    )


@query
def rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = features.series_window("service_zone")
    rolled = features.with_rolling_means(_demand(spark, sf_dir), window, features.ROLLING)
    return rolled.select("service_type", "zone_id", "ts_hour", *[f"rolling_mean_{n}" for n in features.ROLLING])


@query
def forecast_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.forecast_features(_stored_demand(spark, sf_dir), partition="zone")


@query
def forecast_features_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.forecast_features(_stored_demand(spark, sf_dir))


@query
def features_densified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.forecast_features(_stored_demand(spark, sf_dir), densify=True, months=DENSE_MONTHS)


@query
def features_by_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The densified features of the hours that have trips, without filling any."""
    return features.clock_features(_stored_demand(spark, sf_dir), months=DENSE_MONTHS)


def _split(spark: SparkSession, sf_dir: str, lags=features.LAGS) -> tuple[DataFrame, DataFrame]:
    built = features.forecast_features(_stored_demand(spark, sf_dir), partition="zone", lags=lags)
    return features.split_by_month(built)


@query
def train_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)[0]


@query
def test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)[1]


# Forecast


@query
def baseline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = _split(spark, sf_dir, LAGS_WITH_SEASONAL)
    return forecast.baseline_metrics(test)


@query
def baseline_improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = _split(spark, sf_dir, LAGS_WITH_SEASONAL)
    return forecast.rmse_improvement(forecast.baseline_metrics(test), model="baseline_seasonal")


@query
def busiest_zone_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test = _split(spark, sf_dir)
    return forecast.busiest_zone_series(test, prediction="lag_24")


def _dense_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    run = run_over(spark, sf_dir)

    def build() -> DataFrame:
        built = features.forecast_features(
            _stored_demand(spark, sf_dir), densify=True, lags=LAGS_WITH_SEASONAL, months=DENSE_MONTHS
        )
        return run.work.store(built, "features")

    return features.split_by_month(run.once("features", build))


def _fitted(spark: SparkSession, sf_dir: str) -> ForecastRun:
    """The full grid, fitted once for all queries that report on it."""
    run = run_over(spark, sf_dir)
    keep = functools.partial(run.work.store, name="predictions")
    return run.once("fitted", lambda: fit_and_score(*_dense_split(spark, sf_dir), keep))


@query
def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _split(spark, sf_dir)
    return forecast.with_folds(train).groupBy("fold").agg(F.count("*").alias("rows"))


@query
def forward_fold_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and hours of the forward-chaining folds: no training row within the gap before a judged one."""
    train, _ = _dense_split(spark, sf_dir)
    return forecast.fold_sizes(train, forecast.forward_folds(train))


@query
def cv_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.cross_validation_table(spark, _fitted(spark, sf_dir).model)


@query
def gbt_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _fitted(spark, sf_dir)
    gain = forecast.rmse_improvement(run.metrics).select(
        F.lit("gbt_cv").alias("model"), "rmse_improvement_pct"
    )
    return run.metrics.join(F.broadcast(gain), "model", "left")


@query
def gbt_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir).predictions


@query
def gbt_scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stored predictions say about their rows: every row of the test split, as it was."""
    keys = ("service_type", "zone_id", "ts_hour", "pickups", "lag_1", "lag_23", "lag_24", "lag_168", "label")
    return _fitted(spark, sf_dir).predictions.select(*keys)


@query
def dense_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline rows of the model's metrics table."""
    return _fitted(spark, sf_dir).metrics.filter("model LIKE 'baseline%'")


@query
def gbt_zone_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.busiest_zone_series(_fitted(spark, sf_dir).predictions)


@query
def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(spark, sf_dir).importances


@query
def cv_grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters of the searched grid, and whether each has a mean error."""
    table = forecast.cross_validation_table(spark, _fitted(spark, sf_dir).model)
    return table.select("max_depth", "max_iter", (F.col("avg_rmse") > 0).alias("judged"))


@query
def importance_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _fitted(spark, sf_dir).importances
    return found.agg(F.count("*").alias("features"), F.sum("importance").alias("total"), (F.min("importance") >= 0).alias("none_negative"))


@query
def gbt_metrics_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's reported errors against those of its stored predictions, added up in another way."""
    run = _fitted(spark, sf_dir)
    gap = F.abs(F.col("label") - F.col("prediction"))
    again = run.predictions.agg(
        F.lit("gbt_cv").alias("model"),
        F.round(F.sum(gap) / F.count("label"), 4).alias("mae_again"),
        F.round(F.sqrt((F.var_pop(gap) + F.avg(gap) * F.avg(gap))), 4).alias("rmse_again"),
    )
    # One row on either side: put together by grouping, as a join on a constant is a cross join.
    reported = run.metrics.filter("model = 'gbt_cv'").unionByName(again, allowMissingColumns=True)
    values = ("mae", "rmse", "mae_again", "rmse_again")
    both = reported.groupBy("model").agg(*[F.max(c).alias(c) for c in values])
    return both.select(
        "model",
        (F.abs(F.col("mae") - F.col("mae_again")) < 2e-4).alias("mae_agrees"),
        (F.abs(F.col("rmse") - F.col("rmse_again")) < 2e-4).alias("rmse_agrees"),
    )


@query
def gbt_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored prediction against the exported trees, scored as one expression."""
    run = _fitted(spark, sf_dir)
    again = forecast.tree_prediction(*forecast.exported_trees(run.model))
    same = F.abs(again - F.col("prediction")) < 1e-6
    return run.predictions.select(*forecast.ROW_KEY, same.alias("agrees"))


@query
def gbt_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prediction sample's rows: so many, by the digest of their keys."""
    return forecast.prediction_table(_fitted(spark, sf_dir).predictions, SAMPLE_ROWS).select(*forecast.ROW_KEY, "label")
