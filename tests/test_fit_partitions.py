"""The tasks of a fit follow its rows, however many files these come in."""

import pytest

from kerbside.operators import forecast
from kerbside.plans import forecasting


class Stopped(Exception):
    pass


@pytest.mark.parametrize(("rows", "most", "partitions"), [(60, 100, 1), (60, 20, 3), (0, 20, 1)])
def test_fit_tasks_follow_the_rows(spark, monkeypatch, rows, most, partitions):
    found = []

    def stop(train, *_):
        found.append((train.count(), train.rdd.getNumPartitions()))
        raise Stopped

    monkeypatch.setattr(forecast, "cross_validate", stop)
    monkeypatch.setattr(forecasting, "FIT_ROWS", most, raising=False)
    train = spark.range(0, rows, 1, 40)
    with pytest.raises(Stopped):
        forecasting.fit_and_score(train, train, lambda df: df)
    assert found == [(rows, partitions)]
