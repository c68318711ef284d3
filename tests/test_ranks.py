import math
import random

import pytest

from kerbside.functions import ranks
from kerbside.operators import insights
from kerbside.session import Workspace
from tests.trips import trips


def brute(first, second):
    u = sum((a > b) + (a == b) / 2 for a in first for b in second)
    n1, n2, n = len(first), len(second), len(first) + len(second)
    every = [*first, *second]
    ties = sum(every.count(v) ** 3 - every.count(v) for v in set(every))
    spread = math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (u - n1 * n2 / 2) / spread
    return n1, n2, u, u / (n1 * n2), z, math.erfc(abs(z) / math.sqrt(2))


def outcome(spark, rows):
    with Workspace(spark, "t") as work:
        values = spark.createDataFrame(rows, "g string, v double").repartition(5)
        return tuple(ranks.rank_test(values, "g", "v", "a", "b", work).first())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rank_test_by_brute_force(spark, seed):
    rng = random.Random(seed)
    first = [float(rng.randint(0, 9) + seed - 2) for _ in range(40)]
    second = [float(rng.randint(0, 9)) for _ in range(55)]
    rows = [("a", v) for v in first] + [("b", v) for v in second] + [("c", 3.0), ("a", None), ("b", None)]
    assert outcome(spark, rows) == pytest.approx(brute(first, second), abs=2e-7)


def test_rank_test_without_a_group_or_a_difference(spark):
    assert outcome(spark, [("a", 1.0), ("a", 2.0)]) == (2, 0, 0.0, None, None, None)
    assert outcome(spark, [("a", 1.0), ("b", 1.0)]) == (1, 1, 0.5, 0.5, None, None)
    assert outcome(spark, [("c", 1.0)])[:2] == (0, 0)


def test_a_hot_value_is_one_row(spark):
    with Workspace(spark, "t") as work:
        values = spark.range(300_000).selectExpr("IF(id % 2 = 0, 'a', 'b') AS g", "IF(id % 3 = 0, 7.0D, CAST(id % 100 AS DOUBLE)) AS v")
        found = ranks.rank_test(values, "g", "v", "a", "b", work).first()
    assert found.n_first == found.n_second == 150_000 and 0.45 < found.superiority < 0.55


def test_running_totals_over_many_ranges(spark):
    rows = [(k, k % 7) for k in random.Random(5).sample(range(10_000), 2_000)]
    with Workspace(spark, "t") as work:
        found = ranks.with_total_before(spark.createDataFrame(rows, "k long, n long").repartition(6), "k", "n", work)
        got = {r.k: r.before for r in found.collect()}
    total, want = 0, {}
    for k, n in sorted(rows):
        want[k], total = total, total + n
    assert got == want


def test_box_whiskers_and_outliers(spark):
    shares = [0.0, 0.4, 0.41, 0.42, 0.43, 0.44, 0.45, 0.46, 1.0]
    rows = [("yellow", 132, hour, 10, share) for hour, share in enumerate(shares)] + [("yellow", 161, 1, 5, 0.3), ("yellow", 9, 1, 5, 0.9)]
    table = spark.createDataFrame(rows, "service_type string, zone_id int, hour int, trip_count bigint, share_long_trips double")
    boxes = {r.zone_group: r for r in insights.zone_group_boxes(table).collect()}
    assert (boxes["Airport"].whisker_low, boxes["Airport"].whisker_high, boxes["Airport"].outliers) == (0.4, 0.46, 2)
    assert (boxes["Midtown"].whisker_low, boxes["Midtown"].q1, boxes["Midtown"].outliers) == (0.3, 0.3, 0)
    assert sorted(r.share_long_trips for r in insights.zone_group_outliers(table).collect()) == [0.0, 1.0]
    assert insights.zone_group_boxes(table.limit(0)).count() == 0


def test_airport_trips_against_midtown(spark):
    rows = [{"pu": 132, "seconds": 900 + i} for i in range(9)] + [{"pu": 161, "seconds": 300 + i} for i in range(9)] + [{"pu": 5}]
    with Workspace(spark, "t") as work:
        found = insights.duration_rank_test(trips(spark, rows), work).first()
    assert (found.n_first, found.n_second, found.superiority) == (9, 9, 1.0) and found.p < 0.001
