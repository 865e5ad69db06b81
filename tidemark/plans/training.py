"""Train on the stored training frame, register and promote the best model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import LakeConfig, materialise, scratch
from tidemark.ml import prepare, training
from tidemark.ml.registry import ModelRegistry
from tidemark.plans import features
from tidemark.plans.features import ORDER

KEYS = ["city", "recorded_at"]


def run(spark: SparkSession, lake: LakeConfig, algorithms=None) -> training.Trained | None:
    """None when there is no training data."""
    frame = features.table(spark, lake, "training_data").read()
    if frame is None:
        return None
    encoder = prepare.fit_encoder(prepare.usable(frame))
    with scratch(spark):
        ready = materialise(prepare.engineer(frame, encoder, ORDER), "training")
        results = training.train_all(ready, prepare.input_columns(ready), KEYS, algorithms)
    winner = training.best(results)
    registry = ModelRegistry(spark, lake.registry)
    number = registry.versions().count() + 1
    path = f"{lake.models}/{number}"
    # One pipeline: a request's category is encoded as the training rows' was.
    training.save(training.with_category(encoder, winner.model), f"{path}/forecaster")
    version = registry.register(
        winner.algorithm, {"mae": winner.mae, "rmse": winner.rmse, "r2": winner.r2}, path
    )
    registry.promote(version)
    return winner


def production_model(spark: SparkSession, lake: LakeConfig):
    """The promoted model and its version, or (None, "") before the first training."""
    row = ModelRegistry(spark, lake.registry).latest(("Production",)).first()
    if row is None:
        return None, ""
    return training.load(f"{row['path']}/forecaster"), str(row["version"])


def forecast(
    spark: SparkSession, lake: LakeConfig, requests: DataFrame, latest: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Forecasts by the production model, or by the fallback rule, and the rejected requests.

    ``latest`` has the newest feature row of each city, by default from the stored hours.
    """
    from tidemark.ml import scoring
    from tidemark.plans.online import latest_features

    accepted, rejected = scoring.split_requests(requests)
    model, version = production_model(spark, lake)
    if latest is None:
        hourly = features.table(spark, lake, "hourly_weather").read()
        latest = None if hourly is None else latest_features(hourly)
    return scoring.score(accepted, latest, model, version), rejected
