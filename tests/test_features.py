import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators import features as X
from tests.trips import START, demand, shuffled

MONTHS = ("2024-12", "2024-12")
MIDNIGHT = dt.datetime(2024, 12, 1)
KEY = ("service_type", "zone_id", "ts_hour")


def series(n, service="yellow", zone=1, seed=3):
    rng = random.Random(seed)
    return [(service, zone, h, rng.randrange(50)) for h in range(n)]


def keyed(df):
    return {tuple(r[k] for k in KEY): r for r in df.collect()}


def test_lags_means_and_label_against_brute_force(spark):
    rows = series(200)
    built = X.forecast_features(demand(spark, rows))
    pickups = [r[3] for r in rows]
    got = sorted(built.collect(), key=lambda r: r.ts_hour)
    assert len(got) == 200 - 169
    for row in got:
        i = int((row.ts_hour - START).total_seconds() // 3600)
        assert (row.lag_1, row.lag_24, row.lag_168) == (pickups[i - 1], pickups[i - 24], pickups[i - 168])
        assert row.rolling_mean_24 == pytest.approx(sum(pickups[i - 24 : i]) / 24)
        assert row.rolling_mean_168 == pytest.approx(sum(pickups[i - 168 : i]) / 168)
        assert row.label == pickups[i + 1]
        assert (row.feat_year, row.feat_month, row.month_num) == (2024, 12, 12)


def test_rolling_mean_of_short_series(spark):
    rolled = X.with_rolling_means(demand(spark, series(5)), X.series_window("service_zone"), (3,))
    pickups = [r[3] for r in series(5)]
    got = [r.rolling_mean_3 for r in rolled.orderBy("ts_hour").collect()]
    want = [None, *[sum(pickups[max(0, i - 3) : i]) / min(i, 3) for i in range(1, 5)]]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("n", [0, 1, 168, 169, 170, 175])
def test_rows_left_per_series(spark, n):
    assert X.forecast_features(demand(spark, series(n))).count() == max(0, n - 169)


def test_services_share_a_series_only_by_zone(spark):
    rows = series(100) + series(100, service="green")
    df = demand(spark, rows)
    assert X.forecast_features(df).count() == 0
    assert X.forecast_features(df, partition="zone").count() == 200 - 169


def test_row_order_does_not_matter(spark):
    df = demand(spark, series(200) + series(200, service="green", seed=4))
    for partition in X.SERIES:
        a = keyed(X.forecast_features(df, partition=partition))
        b = keyed(X.forecast_features(shuffled(df), partition=partition))
        assert a == b


def test_only_top_zones_remain(spark):
    rows = [("yellow", z, h, p) for z, p in ((1, 5), (2, 9), (3, 9)) for h in range(3)]
    kept = X.keep_top_zones(demand(spark, rows), 1)
    assert {r.zone_id for r in kept.collect()} == {2}
    assert kept.columns == demand(spark, []).columns


def test_fill_hours(spark):
    rows = [("yellow", 1, 2, 7), ("yellow", 1, 5, 1), ("green", 1, 0, 3), ("green", 2, 6, 4)]
    filled = X.fill_hours(demand(spark, rows), MONTHS)
    filled = filled.filter(F.col("ts_hour").between(F.lit(START), F.lit(START + dt.timedelta(hours=6))))
    got = {(r.service_type, r.zone_id): {} for r in filled.collect()}
    for r in filled.collect():
        got[(r.service_type, r.zone_id)][int((r.ts_hour - START).total_seconds() // 3600)] = r.pickups
    assert got == {
        ("yellow", 1): {h: {2: 7, 5: 1}.get(h, 0) for h in range(7)},
        ("green", 1): {h: {0: 3}.get(h, 0) for h in range(7)},
        ("green", 2): {h: {6: 4}.get(h, 0) for h in range(7)},
    }
    assert filled.filter("pickups = 0 AND p50_duration IS NOT NULL").count() == 0
    assert filled.columns == demand(spark, []).columns


def test_fill_hours_leaves_stray_dates_out(spark):
    hours = 24 * 31
    base = [("yellow", 1, 3, 7), ("yellow", 1, 700, 1)]
    stray = [("yellow", 1, -24 * 365 * 20, 1), ("yellow", 1, 24 * 365 * 70, 1), ("green", 5, 24 * 900, 2)]
    for rows in (base, base + stray, base + stray[:1], base + stray[1:2]):
        filled = X.fill_hours(demand(spark, rows), MONTHS).collect()
        assert len(filled) == hours and sum(r.pickups for r in filled) == 8
        assert min(r.ts_hour for r in filled) == MIDNIGHT
        assert max(r.ts_hour for r in filled) == MIDNIGHT + dt.timedelta(hours=hours - 1)
    assert X.fill_hours(demand(spark, stray), MONTHS).count() == 0
    left_out = X.outside_hours(demand(spark, base + stray), MONTHS).collect()
    assert {(r.service_type, r.zone_id): (r.hours, r.pickups) for r in left_out} == {("yellow", 1): (2, 2), ("green", 5): (1, 2)}


def test_densified_rows_are_hours(spark):
    rows = [r for r in series(400) if r[2] % 7]
    by_hour = {h: p for _, _, h, p in rows}
    for row in X.forecast_features(demand(spark, rows), densify=True, months=MONTHS).collect():
        h = int((row.ts_hour - START).total_seconds() // 3600)
        assert row.lag_24 == by_hour.get(h - 24, 0) and row.label == by_hour.get(h + 1, 0)


def test_densify_needs_service_series(spark):
    with pytest.raises(ValueError, match="service_zone"):
        X.forecast_features(demand(spark, []), partition="zone", densify=True)


def test_split_has_no_overlap_and_keeps_gaps_out(spark):
    months = [(2023, 12), (2024, 11), (2024, 12), (2025, 1), (2025, 2), (2026, 1)]
    df = spark.createDataFrame(months, "feat_year int, feat_month int")
    train, test = X.split_by_month(df)
    assert {tuple(r) for r in train.collect()} == set(months[:3])
    assert {tuple(r) for r in test.collect()} == set(months[3:])
    early, late = X.split_by_month(df, "2023-12", "2025-02")
    assert (early.count(), late.count()) == (1, 2)


def test_clock_features_equal_the_densified_rows_that_exist(spark):
    rng = random.Random(4)
    hours = sorted(rng.sample(range(-30, 24 * 40), 300))
    rows = [(s, z, h, rng.randint(1, 9)) for s, z in (("yellow", 1), ("fhv", 1), ("yellow", 2)) for h in hours if rng.random() < 0.8]
    rows += [("green", 3, 24 * 31 + 743, 5), ("green", 3, 400, 2)]
    table = demand(spark, rows)
    span = ("2024-12", "2025-01")
    for lags, rolling in (((1, 23, 24, 168), (24, 168)), ((2,), (1, 700))):
        filled = X.forecast_features(table, densify=True, lags=lags, rolling=rolling, months=span)
        clock = X.clock_features(table, lags=lags, rolling=rolling, months=span)
        want = filled.filter("p50_duration IS NOT NULL")
        assert clock.dtypes == want.dtypes and want.count() > 300
        assert sorted(map(tuple, clock.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_clock_features_take_one_exchange_and_fill_nothing(spark):
    plan = X.clock_features(demand(spark, [("yellow", 1, 0, 1)]), top_n=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan
