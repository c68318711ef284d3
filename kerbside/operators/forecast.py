"""Gradient-boosted-tree forecast with MLlib, its folds, metrics and reports."""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.features import FEATURES
from kerbside.operators.insights import keep_members, top_by
from kerbside.settings import SEED

# The searched grid and the number of folds.
MAX_DEPTH = (3, 5)
MAX_ITER = (20, 50)
FOLDS = 3
# Hours between the last training row and the first row it is judged on: the longest lag.
GAP_HOURS = 168

ROW_KEY = ("service_type", "zone_id", "ts_hour")


def build_pipeline(features: Sequence[str] = FEATURES) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    trees = GBTRegressor(featuresCol="features", labelCol="label", seed=SEED)
    return Pipeline(stages=[assembler, trees])


def param_grid(
    pipeline: Pipeline, max_depth: Sequence[int] = MAX_DEPTH, max_iter: Sequence[int] = MAX_ITER
) -> list[dict]:
    trees = pipeline.getStages()[-1]
    grid = ParamGridBuilder().addGrid(trees.maxDepth, list(max_depth))
    return grid.addGrid(trees.maxIter, list(max_iter)).build()


def with_folds(train: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Fold number from a digest of the row's zone and hour: the same in every run and every engine."""
    key = F.concat_ws("|", "zone_id", F.date_format("ts_hour", "yyyy-MM-dd HH"))
    number = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    return train.withColumn("fold", (number % folds).cast("int"))


def cross_validate(
    train: DataFrame,
    max_depth: Sequence[int] = MAX_DEPTH,
    max_iter: Sequence[int] = MAX_ITER,
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Best of the grid by mean RMSE over the key-hash folds, refitted on all rows.

    Pass a stored or checkpointed frame: every fit reads it again.
    """
    pipeline = build_pipeline()
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=param_grid(pipeline, max_depth, max_iter),
        evaluator=RegressionEvaluator(labelCol="label", metricName="rmse"),
        numFolds=FOLDS,
        foldCol="fold",
        parallelism=parallelism,
    )
    return validator.fit(with_folds(train))


@dataclass(frozen=True)
class ForwardFold:
    """Training rows lie before ``train_before``, judged ones from ``valid_from`` to before ``valid_before``; hours since 1970."""

    fold: int
    train_before: int
    valid_from: int
    valid_before: int

    def training(self) -> Column:
        return _hour_number() < self.train_before

    def validation(self) -> Column:
        return (_hour_number() >= self.valid_from) & (_hour_number() < self.valid_before)


def _hour_number() -> Column:
    return F.floor(F.unix_timestamp("ts_hour") / 3600)


def forward_folds(train: DataFrame, folds: int = FOLDS, gap_hours: int = GAP_HOURS) -> list[ForwardFold]:
    """Growing training ranges, each judged on the block of hours that follows it after a gap.

    The hours from the first to the last row make ``folds`` + 1 equal blocks, the last
    one takes the rest; block 0 is trained on only. No training row is nearer than
    ``gap_hours`` to a judged one, so that no judged row's lags reach into the training
    rows. Without rows there are no folds.
    """
    first, last = train.agg(F.min(_hour_number()), F.max(_hour_number())).first()
    if first is None:
        return []
    block = (last - first + 1) // (folds + 1)
    starts = [first + block * i for i in range(1, folds + 1)]
    ends = [*starts[1:], last + 1]
    return [
        ForwardFold(i, start - gap_hours, start, end)
        for i, (start, end) in enumerate(zip(starts, ends, strict=True))
    ]


def fold_sizes(train: DataFrame, folds: Sequence[ForwardFold]) -> DataFrame:
    """fold, role, rows, first_hour, last_hour of every fold's two sides; one pass over the rows."""
    sides = [(f.fold, role, test) for f in folds for role, test in (("train", f.training()), ("validate", f.validation()))]
    member = F.array(*[F.when(test, F.struct(F.lit(n).alias("fold"), F.lit(r).alias("role"))) for n, r, test in sides])
    placed = train.select("ts_hour", F.explode(F.filter(member, lambda m: m.isNotNull())).alias("side"))
    return placed.groupBy("side.fold", "side.role").agg(
        F.count("*").alias("rows"), F.min("ts_hour").alias("first_hour"), F.max("ts_hour").alias("last_hour")
    )


@dataclass(frozen=True)
class ForwardValidation:
    """``errors``: (fold, max_depth, max_iter, rmse); ``best``: the grid point with the smallest mean; ``model``: fitted on all rows."""

    errors: list[tuple[int, int, int, float]]
    best: tuple[int, int]
    model: PipelineModel

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.errors, "fold int, max_depth int, max_iter int, rmse double")


def forward_validate(
    train: DataFrame,
    max_depth: Sequence[int] = MAX_DEPTH,
    max_iter: Sequence[int] = MAX_ITER,
    folds: int = FOLDS,
    gap_hours: int = GAP_HOURS,
    parallelism: int = 4,
) -> ForwardValidation:
    """Best of the grid by mean RMSE over the forward folds, refitted on all rows; ties take the smaller trees.

    Pass a stored or cached frame: every fit reads it again. A fold without rows on
    either side, as in a short range, is left out; when none is left this raises.
    """
    pipeline = build_pipeline()
    found = forward_folds(train, folds, gap_hours)
    sizes = {(r.fold, r.role) for r in fold_sizes(train, found).collect()} if found else set()
    usable = [f for f in found if {(f.fold, "train"), (f.fold, "validate")} <= sizes]
    if not usable:
        raise ValueError("the rows span too few hours for a fold")
    grid = list(itertools.product(max_depth, max_iter))

    def settings(depth: int, rounds: int) -> dict:
        trees = pipeline.getStages()[-1]
        return {trees.maxDepth: depth, trees.maxIter: rounds}

    def error(task) -> tuple[int, int, int, float]:
        fold, (depth, rounds) = task
        model = pipeline.fit(train.filter(fold.training()), settings(depth, rounds))
        scored = model.transform(train.filter(fold.validation()))
        return fold.fold, depth, rounds, scored.agg(error_columns("prediction")[1]).first()[0]

    with ThreadPoolExecutor(parallelism) as pool:
        errors = list(pool.map(error, itertools.product(usable, grid)))
    means = {point: sum(e for _, d, i, e in errors if (d, i) == point) / len(usable) for point in grid}
    best = min(grid, key=lambda point: (means[point], point))
    return ForwardValidation(errors, best, pipeline.fit(train, settings(*best)))


def error_columns(prediction: str, label: str = "label") -> tuple[Column, Column]:
    """Aggregates: mean absolute error and root mean squared error."""
    gap = F.col(label) - F.col(prediction)
    return F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse")


def metrics(df: DataFrame, predictions: dict[str, str]) -> DataFrame:
    """model, mae, rmse for each (model name, prediction column), in one pass over the rows."""
    sums = df.agg(
        *[
            F.struct(F.lit(model).alias("model"), *error_columns(column)).alias(model)
            for model, column in predictions.items()
        ]
    )
    return sums.select(F.inline(F.array(*[F.col(model) for model in predictions])))


def baseline_metrics(test: DataFrame) -> DataFrame:
    """Naive forecasts: the value 24 rows back, and the previous day's value of the predicted hour.

    The label is one row ahead, so the latter is ``lag_23``; it is reported when the frame has it.
    """
    naive = {"baseline_lag24": "lag_24", "baseline_seasonal": "lag_23"}
    return metrics(test, {model: c for model, c in naive.items() if c in test.columns})


def model_metrics(predictions: DataFrame, name: str = "gbt_cv") -> DataFrame:
    """Metrics of scored rows; pass them as stored, or the model is applied again."""
    return metrics(predictions, {name: "prediction"})


def metrics_table(*parts: DataFrame) -> DataFrame:
    """Metrics of several models, to four decimals."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.select("model", *[F.round(c, 4).alias(c) for c in ("mae", "rmse")])


def rmse_improvement(table: DataFrame, baseline: str = "baseline_lag24", model: str = "gbt_cv") -> DataFrame:
    """By how many percent the model's RMSE is below the baseline's; null for a perfect baseline."""

    def rmse(name: str) -> Column:
        return F.max(F.when(F.col("model") == name, F.col("rmse")))

    gain = (rmse(baseline) - rmse(model)) / F.nullif(rmse(baseline), F.lit(0.0)) * 100
    return table.agg(gain.alias("rmse_improvement_pct"))


def feature_importances(spark: SparkSession, model: CrossValidatorModel | PipelineModel) -> DataFrame:
    """feature, importance; the largest first."""
    fitted = model.bestModel if isinstance(model, CrossValidatorModel) else model
    names = fitted.stages[0].getInputCols()
    weights = fitted.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(names, weights, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def cross_validation_table(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """max_depth, max_iter and mean RMSE of every searched grid point."""
    points = [
        {param.name: value for param, value in point.items()} for point in model.getEstimatorParamMaps()
    ]
    rows = [(p["maxDepth"], p["maxIter"], float(m)) for p, m in zip(points, model.avgMetrics, strict=True)]
    return spark.createDataFrame(rows, "max_depth int, max_iter int, avg_rmse double")


def prediction_table(predictions: DataFrame, n: int | None = None) -> DataFrame:
    """The predictions without the vector column; with ``n``, so many by a digest of their keys, the same ones in every run."""
    plain = predictions.drop("features")
    digest = F.md5(F.concat_ws("|", "service_type", "zone_id", F.date_format("ts_hour", "yyyy-MM-dd HH")))
    return plain if n is None else plain.orderBy(digest, *ROW_KEY).limit(n)


def busiest_zone_series(
    predictions: DataFrame, prediction: str = "prediction", n: int | None = None
) -> DataFrame:
    """Actual and predicted demand in the zone with the largest label total; with ``n``, its first points."""
    totals = predictions.groupBy("zone_id").agg(F.sum("label").alias("total"))
    busiest = top_by(totals, "zone_id", "total", 1).select("zone_id")
    series = (
        keep_members(predictions, busiest, "zone_id")
        .orderBy("ts_hour", "service_type")
        .select("ts_hour", "service_type", "zone_id", "label", F.col(prediction).alias("prediction"))
    )
    return series if n is None else series.limit(n)


@dataclass(frozen=True)
class TreeNode:
    """A split (feature, threshold; left if not above it) or, without a feature, a leaf's prediction."""

    tree: int
    node: int
    feature: str | None = None
    threshold: float | None = None
    left: int | None = None
    right: int | None = None
    prediction: float | None = None


_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


def exported_trees(model: CrossValidatorModel | PipelineModel) -> tuple[list[float], list[TreeNode]]:
    """(weights, nodes) of the fitted trees as plain values; a tree's nodes are numbered from its root, 0, depth first."""
    fitted = model.bestModel if isinstance(model, CrossValidatorModel) else model
    names, trees = fitted.stages[0].getInputCols(), fitted.stages[-1]
    nodes: list[TreeNode] = []
    for number, tree in enumerate(trees.trees):
        lines = iter([line.strip() for line in tree.toDebugString.splitlines()[1:] if line.strip()])
        numbers = itertools.count()

        def read(number: int = number, lines=lines, numbers=numbers) -> int:
            """Notes the node that the next line starts, and all below it."""
            line, node = next(lines), next(numbers)
            if line.startswith("Predict:"):
                nodes.append(TreeNode(number, node, prediction=float(line.split(":")[1])))
                return node
            feature, threshold = _SPLIT.fullmatch(line).groups()
            left = read(number, lines, numbers)
            next(lines)  # the line "Else"
            right = read(number, lines, numbers)
            nodes.append(TreeNode(number, node, names[int(feature)], float(threshold), left, right))
            return node

        read()
    return list(trees.treeWeights), nodes


def tree_prediction(weights: Sequence[float], nodes: Sequence[TreeNode]) -> Column:
    """The model as one expression over its feature columns: no vectors and no MLlib where it scores."""
    by_place = {(n.tree, n.node): n for n in nodes}

    def value(tree: int, node: int) -> str:
        found = by_place[tree, node]
        if found.feature is None:
            return f"{found.prediction!r}D"
        return f"IF(`{found.feature}` <= {found.threshold!r}D, {value(tree, found.left)}, {value(tree, found.right)})"

    return F.expr(" + ".join(f"{weight!r}D * {value(tree, 0)}" for tree, weight in enumerate(weights)))


def tree_table(spark: SparkSession, nodes: Sequence[TreeNode]) -> DataFrame:
    """The nodes as rows, to store beside a model."""
    rows = [(n.tree, n.node, n.feature, n.threshold, n.left, n.right, n.prediction) for n in nodes]
    return spark.createDataFrame(
        rows, "tree int, node int, feature string, threshold double, left int, right int, prediction double"
    )
