"""Fit three regressors, compare them, keep the best."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_point
from tidemark.ml.prepare import LABEL, Scaling, category_stages, fit_scaling, in_training

# Model parameters.
FOREST = {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 2, "seed": 42}
BOOSTING = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "seed": 42}
RIDGE_ALPHA = 1.0

# Rows of a task that fits; its part of the cached rows stays far below the 2 GB of a block.
ROWS_PER_FIT = 500_000


def forest(train: DataFrame, **other) -> Model:
    """All features at every split; the smallest node that may split has about five rows.
    ``other`` parameters replace the fixed ones. Each row's nodes are kept from level to
    level, so no level walks all trees from their roots again."""
    fixed = {"featureSubsetStrategy": "all", "cacheNodeIds": True}
    return RandomForestRegressor(labelCol=LABEL, **fixed | FOREST | other).fit(train)


def boosting(train: DataFrame, **other) -> Model:
    return GBTRegressor(labelCol=LABEL, **BOOSTING | other).fit(train)


def ridge(train: DataFrame, label: str = LABEL, alpha: float = RIDGE_ALPHA) -> Model:
    """Least squares with penalty ``alpha * |w|²`` on the sum of squares.

    Spark scales the penalty by rows and label deviation, so it is converted.
    """
    row = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("s")).first()
    return LinearRegression(
        labelCol=label,
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
        regParam=alpha * (row["s"] or 0.0) / row["n"],
    ).fit(train)


# Algorithm names.
ALGORITHMS: dict[str, Callable[[DataFrame], Model]] = {
    "RandomForest": forest,
    "GradientBoosting": boosting,
    "Ridge": ridge,
}


def metrics(
    scored: DataFrame,
    label: str,
    prediction: str = "prediction",
    digits: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """MAE, RMSE and R² in one aggregate, per group of ``by`` if given."""
    scale: Column | float = 1.0
    y, error = F.col(label), F.col(prediction) - F.col(label)
    if digits is not None:
        y = fixed_point.units(label, digits).cast("decimal(19,0)")
        error = fixed_point.units(prediction, digits).cast("decimal(19,0)") - y
        scale = float(10**digits)
    n = F.count(F.lit(1))
    sums = scored.filter(F.col(label).isNotNull()).groupBy(*by).agg(
        n.alias("n"),
        F.sum(F.abs(error)).cast("double").alias("absolute"),
        F.sum(error * error).cast("double").alias("squared"),
        *_spread(y, digits),
    )
    return sums.select(
        *by,
        (F.col("absolute") / F.col("n") / scale).alias("mae"),
        (F.sqrt(F.col("squared") / F.col("n")) / scale).alias("rmse"),
        (1 - F.col("squared") / F.nullif(F.col("spread"), F.lit(0.0))).alias("r2"),
    )


def _spread(y: Column, digits: int | None) -> list[Column]:
    """Sum of squared deviations from the mean."""
    if digits is None:
        return [(F.var_pop(y) * F.count(F.lit(1))).alias("spread")]
    n, total = F.count(F.lit(1)), F.sum(y)
    # Exact products would need more than 38 digits on very large tables.
    exact = F.sum(y * y).cast("double") - total.cast("double") * (total.cast("double") / n)
    return [exact.alias("spread")]


@dataclass(frozen=True)
class Trained:
    algorithm: str
    model: PipelineModel
    mae: float
    rmse: float
    r2: float


def assemble(columns: Sequence[str], scaling: Scaling) -> PipelineModel:
    """Scaling and column order as fitted stages shared by training and scoring."""
    vector = VectorAssembler(inputCols=[f"scaled_{c}" for c in columns], outputCol="features")
    return PipelineModel([scaling.transformer(), vector])


def with_category(encoder: StringIndexerModel, model: PipelineModel) -> PipelineModel:
    """A trained model that takes the category instead of its code."""
    return PipelineModel([*category_stages(encoder), *model.stages])


def dealt(train: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows in even parts, a whole number for each core, and in order within a part.

    Trees pass over the rows hundreds of times. Rows next to each other then mostly fall into
    the same nodes, which takes half the time; and what a forest draws depends on the rows
    and the number of parts, not on the files they come from.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    waves = max(1, -(-train.count() // (cores * ROWS_PER_FIT)))
    return train.repartition(cores * waves, *keys).sortWithinPartitions(*columns, *keys, LABEL)


def train_all(
    frame: DataFrame, columns: Sequence[str], keys: Sequence[str], algorithms=None
) -> list[Trained]:
    """Split by key, scale on the training side, fit and evaluate every algorithm."""
    side = in_training(keys)
    train, test = frame.filter(side), frame.filter(~side)
    inputs = assemble(columns, fit_scaling(train, columns))
    vectors = inputs.transform(dealt(train, columns, keys)).select("features", LABEL).persist()
    try:
        out = []
        for name, fit in (algorithms or ALGORITHMS).items():
            model = PipelineModel([*inputs.stages, fit(vectors)])
            row = metrics(model.transform(test), LABEL).first()
            out.append(Trained(name, model, row["mae"], row["rmse"], row["r2"]))
        return out
    finally:
        vectors.unpersist()


def best(results: Sequence[Trained]) -> Trained:
    return max(results, key=lambda t: t.r2)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)

