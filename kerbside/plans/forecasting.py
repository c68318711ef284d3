"""The forecast run: features, split, baseline, model, reports; each stored as a table."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession

from kerbside.operators import forecast
from kerbside.operators.features import forecast_features, split_by_month
from kerbside.session import pin_timezone
from kerbside.settings import END_MONTH, START_MONTH, TEST_START, TOP_ZONES, TRAIN_END, Lake
from kerbside.sources.tables import save_parquet

# Training rows of one task: the grid is thousands of short jobs, which wait for their tasks more than for the rows.
FIT_ROWS = 100_000


@dataclass(frozen=True)
class ForecastRun:
    """``predictions`` is a stored table, every scored row without the vector column."""

    model: CrossValidatorModel
    metrics: DataFrame
    predictions: DataFrame
    importances: DataFrame


def fit_and_score(
    train: DataFrame,
    test: DataFrame,
    stored: Callable[[DataFrame], DataFrame],
    max_depth: Sequence[int] = forecast.MAX_DEPTH,
    max_iter: Sequence[int] = forecast.MAX_ITER,
) -> ForecastRun:
    """Cross-validate on ``train`` and compare with the baselines on ``test``.

    Both should be stored or checkpointed frames. The training rows stay cached
    while the grid is searched, spilling to disk; they come back from storage
    when an executor is lost. Their partitions follow their number, not the files
    they come in. ``stored`` writes the predictions and reads them back: the model
    is applied once, and all reports come from the table.
    """
    cached = train.coalesce(math.ceil(train.count() / FIT_ROWS) or 1).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = forecast.cross_validate(cached, max_depth, max_iter)
    finally:
        cached.unpersist()
    predictions = stored(forecast.prediction_table(model.transform(test)))
    scores = forecast.model_metrics(predictions)
    return ForecastRun(
        model=model,
        metrics=forecast.metrics_table(forecast.baseline_metrics(predictions), scores),
        predictions=predictions,
        importances=forecast.feature_importances(test.sparkSession, model),
    )


def run_forecast(
    spark: SparkSession,
    lake: Lake,
    demand: DataFrame,
    top_n: int = TOP_ZONES,
    partition: str = "service_zone",
    densify: bool = False,
    train_end: str = TRAIN_END,
    test_start: str = TEST_START,
    max_depth: Sequence[int] = forecast.MAX_DEPTH,
    max_iter: Sequence[int] = forecast.MAX_ITER,
    months: tuple[str, str] = (START_MONTH, END_MONTH),
    sample_rows: int | None = None,
) -> ForecastRun:
    """Build and store features from the stored mart, then train, score and store the reports.

    ``months`` is the range that ``densify`` fills. All predictions are stored;
    ``sample_rows`` asks for a table of so many of them besides.
    """
    pin_timezone(spark)
    features = forecast_features(demand, top_n, partition, densify, months=months)
    save_parquet(features, lake.gold("model_features"), ("feat_year", "feat_month"), rebalance=True)
    train, test = split_by_month(spark.read.parquet(lake.gold("model_features")), train_end, test_start)

    def stored(predictions: DataFrame) -> DataFrame:
        save_parquet(predictions, lake.gold("model_predictions"))
        return spark.read.parquet(lake.gold("model_predictions"))

    run = fit_and_score(train, test, stored, max_depth, max_iter)
    save_parquet(run.metrics, lake.gold("model_metrics"))
    if sample_rows is not None:
        save_parquet(forecast.prediction_table(run.predictions, sample_rows), lake.gold("model_predictions_sample"))
    return run
