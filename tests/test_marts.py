import datetime as dt
import math
import random

import pytest

from kerbside.operators import insights, marts, profile
from kerbside.operators.timing import demand_by_zone
from tests.trips import START, shuffled, trips

HOUR = dt.timedelta(hours=1)


def random_trips(n, seed=5):
    rng = random.Random(seed)
    return [
        {
            "service": rng.choice(["yellow", "yellow", "green", "fhv"]),
            # A third of the trips share one zone and hour.
            "at": START if i % 3 == 0 else START + dt.timedelta(minutes=rng.randrange(4000)),
            "seconds": rng.choice([None, -5, rng.randrange(1, 4000), rng.randrange(1, 16_000)]),
            "pu": 1 if i % 3 == 0 else rng.choice([None, 1, 2, 3]),
            "do": rng.choice([None, 5, 6]),
            "amount": rng.choice([None, 5.0, 7.25]),
        }
        for i in range(n)
    ]


def usable(rows):
    def ok(r):
        return r["seconds"] is not None and 0 < r["seconds"] <= 14_400

    return [r for r in rows if ok(r)], [r for r in rows if ok(r) and r["pu"] and r["do"]]


def discrete(values, numerator, denominator):
    return float(sorted(values)[math.ceil(len(values) * numerator / denominator - 1e-9) - 1])


def grouped(rows, key):
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row)
    return groups


@pytest.fixture(scope="module")
def sample(spark):
    rows = random_trips(1500)
    return rows, trips(spark, rows).persist()


def test_demand_against_brute_force(sample):
    rows, df = sample
    _, valid = usable(rows)
    want = grouped(
        valid, lambda r: (r["service"], r["pu"], r["at"].replace(minute=0, second=0, microsecond=0))
    )
    got = {(r.service_type, r.zone_id, r.ts_hour): r for r in marts.zone_hour_demand(df).collect()}
    assert got.keys() == want.keys()
    for key, members in want.items():
        seconds = [m["seconds"] for m in members]
        amounts = [m["amount"] for m in members if m["amount"] is not None]
        row = got[key]
        assert row.pickups == len(members)
        assert row.p50_duration == discrete(seconds, 1, 2)
        assert row.p95_duration == discrete(seconds, 19, 20)
        assert row.avg_total_amount == (pytest.approx(sum(amounts) / len(amounts)) if amounts else None)
        assert row.p50_duration <= row.p95_duration


def test_monthly_against_brute_force(sample):
    rows, df = sample
    valid, _ = usable(rows)
    want = grouped(valid, lambda r: (r["service"], r["at"].year, r["at"].month))
    got = {(r.service_type, r.year, r.month): r for r in marts.monthly_service_summary(df).collect()}
    assert got.keys() == want.keys()
    for key, members in want.items():
        seconds = [m["seconds"] for m in members]
        row = got[key]
        assert row.trips == len(members)
        assert row.unique_pu_zones == len({m["pu"] for m in members} - {None})
        assert row.avg_duration_sec == pytest.approx(sum(seconds) / len(seconds))
        assert row.p95_duration_sec == discrete(seconds, 19, 20)


def test_marts_do_not_depend_on_row_order(sample):
    _, df = sample
    for build in (marts.zone_hour_demand, marts.monthly_service_summary, marts.zone_hour_reliability):
        again = build(shuffled(df))
        assert build(df).exceptAll(again).count() == 0 and again.exceptAll(build(df)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 19, 20, 21, 40, 100])
def test_p95_rank_is_exact(spark, n):
    df = trips(spark, [{"seconds": s} for s in range(1, n + 1)])
    row = marts.zone_hour_demand(df).first()
    assert row.p95_duration == -(-n * 19 // 20) and row.p50_duration == -(-n // 2)


def test_long_trip_is_strictly_above_threshold(spark):
    df = trips(spark, [{"seconds": 2_700}, {"seconds": 2_701}, {"seconds": 60, "do": None}])
    row = marts.zone_hour_reliability(df).first()
    assert (row.trip_count, row.share_long_trips) == (2, 0.5)


def test_monthly_counts_trips_without_locations(spark):
    df = trips(spark, [{"pu": None}, {"pu": 4}, {"pu": 4}])
    row = marts.monthly_service_summary(df).first()
    assert (row.trips, row.unique_pu_zones) == (3, 1)


def test_services_stay_apart(spark):
    df = trips(spark, [{"service": "yellow"}, {"service": "green"}])
    assert marts.zone_hour_demand(df).count() == 2


def test_empty_trips(spark):
    df = trips(spark, [])
    assert marts.zone_hour_demand(df).count() == 0
    assert marts.monthly_service_summary(df).count() == 0
    assert profile.quality_overview(df).first().asDict() == {
        "total_rows": 0,
        "valid_rows": 0,
        "valid_pct": None,
    }


def test_ordered_marts(spark):
    df = trips(spark, [{"pu": z, "at": START + HOUR * h} for z, h in ((2, 1), (2, 0), (1, 5))])
    rows = marts.ordered(marts.zone_hour_demand(shuffled(df))).collect()
    assert [(r.zone_id, r.ts_hour) for r in rows] == [(1, START + 5 * HOUR), (2, START), (2, START + HOUR)]


def test_demand_by_zone(spark):
    rows = [{"amount": 1.0}, {"amount": 3.0}, {"at": START + HOUR, "amount": 10.0}]
    row = demand_by_zone(marts.zone_hour_demand(trips(spark, rows))).first()
    assert (row.total_pickups, row.mean_amount) == (3, 6.0)


def test_top_zones_break_ties_by_zone(spark):
    df = marts.zone_hour_demand(trips(spark, [{"pu": z} for z in (9, 3, 5, 5)]))
    assert [r.zone_id for r in insights.top_zones(df, 2).collect()] == [5, 3]


def test_member_sets_carry_no_hint(spark):
    df = marts.zone_hour_demand(trips(spark, [{"pu": 1}, {"pu": 2}]))
    kept = insights.keep_members(df, insights.top_zones(df, 1).select("zone_id"), "zone_id")
    assert "strategy=" not in kept._jdf.queryExecution().logical().toString()
    assert {r.zone_id for r in kept.collect()} == {1}


def test_heatmap_grid_fills_zeros(spark):
    grid = insights.heatmap_grid(insights.demand_heatmap(trips(spark, [{}, {}, {"service": "green"}])))
    row = grid.first()
    assert len(grid.columns) == 25 and (row["8"], row["9"]) == (2, 0)


def test_trend_filters_and_dates(spark):
    monthly = spark.createDataFrame(
        [("yellow", 2024, 5, 1_000), ("yellow", 2024, 6, 2_500_000)],
        "service_type string, year int, month int, trips bigint",
    )
    rows = insights.monthly_trend(monthly).collect()
    assert [(r.month_date, r.trips_millions) for r in rows] == [(dt.date(2024, 6, 1), 2.5)]


def test_long_share_plain_and_weighted(spark):
    reliability = spark.createDataFrame(
        [("yellow", 1, 0, 1, 1.0), ("yellow", 1, 1, 3, 0.0), ("yellow", 7, 1, 3, 0.5)],
        "service_type string, zone_id int, hour int, trip_count bigint, share_long_trips double",
    )
    row = insights.long_share_by_zone(reliability, [1]).first()
    assert (row.avg_share_long, row.total_trips, row.weighted_share_long) == (0.5, 4, 0.25)


def test_zone_groups_from_caller(spark):
    reliability = spark.createDataFrame(
        [(z, float(z)) for z in (1, 2, 3, 4, 5, 9)], "zone_id int, share_long_trips double"
    )
    rows = insights.zone_group_quartiles(reliability, {"low": [1, 2, 3, 4, 5], "other": [8]}).collect()
    assert [tuple(r) for r in rows] == [("low", 1.0, 2.0, 3.0, 4.0, 5.0)]
