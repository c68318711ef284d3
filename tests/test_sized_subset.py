import datetime as dt

import pytest

from kerbside.plans import subset
from kerbside.schema import TRIP_COLUMNS
from kerbside.session import Workspace
from kerbside.settings import Lake
from kerbside.sources.tables import stored_bytes
from tests.trips import START, trips


@pytest.fixture(scope="module")
def many(spark):
    rows = [{"at": START + dt.timedelta(minutes=i), "seconds": 60 + i % 900, "pu": i % 200} for i in range(4_000)]
    return trips(spark, [*rows, *rows[:50], {"at": None}, {"pu": None}]).persist()


def taken(spark, many, size):
    with Workspace(spark, "t") as work:
        return {tuple(r) for r in subset.sample_of_size(many, work, size).collect()}


def test_samples_are_nested_and_keep_the_limit(spark, many):
    total = many.selectExpr("sum(86 + octet_length(service_type))").first()[0]
    sizes = [0, 100, 10_000, 100_000, total - 1, total, 10 * total]
    found = [taken(spark, many, size) for size in sizes]
    assert all(a <= b for a, b in zip(found, found[1:], strict=False))
    assert not found[0] and found[-1] == found[-2] == {tuple(r) for r in many.collect()}
    for size, rows in zip(sizes, found, strict=True):
        assert sum(86 + len(r[0]) for r in rows) <= size
    assert sum(86 + len(r[0]) for r in found[3]) > 90_000


def test_plain_bytes_counts_every_column(spark, many):
    widths = {"timestamp": 8, "double": 8, "int": 4, "boolean": 1}
    want = sum(widths.get(t, 0) for _, t in many.dtypes) + 4 + len("yellow")
    assert many.select(subset.plain_bytes().alias("n")).first().n == want == 86 + len("yellow")


def test_stored_subset_stays_below_its_size(spark, many, tmp_path):
    lake = Lake("", str(tmp_path))
    for size in (40_000, 200_000):
        stored = subset.make_sized_subset(spark, lake, many, size)
        assert 0 < stored_bytes(spark, lake.subset) <= size and stored.columns == TRIP_COLUMNS
        assert {tuple(r) for r in stored.collect()} == taken(spark, many, size)
    with pytest.raises(RuntimeError, match="too few"):
        subset.make_sized_subset(spark, lake, many, 300)
