"""Boosted-tree forecaster on Spark ML, and the naive forecast beside it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from tidemark.config import BASELINE, CLIENT, DATE, TARGET, Settings
from tidemark.operators.features import restore_volume

VECTOR = "features"
PREDICTED_LOG = "pred_log"
PREDICTED_VOLUME = "pred_volume"


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR)


def regressor(settings: Settings = Settings()) -> GBTRegressor:
    """The configured boosted-tree regressor."""
    return GBTRegressor(
        featuresCol=VECTOR,
        labelCol=TARGET,
        predictionCol=PREDICTED_LOG,
        maxIter=settings.trees,
        maxDepth=settings.depth,
        stepSize=settings.learning_rate,
        subsamplingRate=settings.row_sample,
        featureSubsetStrategy=str(settings.column_sample),
        maxBins=settings.max_bins,
        seed=settings.seed,
    )


def fit_layout(train_rows: int, settings: Settings = Settings()) -> Settings:
    """Settings with the number of fit partitions that the training rows ask for.

    A tree takes one job for each of its levels, so few rows in many partitions cost more in
    scheduling than they save. The number follows from the rows alone and is recorded with the
    run: row sampling, and so the model, depends on it."""
    if settings.fit_partitions is not None:
        return settings
    return replace(settings, fit_partitions=-(-max(1, train_rows) // settings.fit_rows_per_partition))


def _training_layout(train: DataFrame, features: Sequence[str], settings: Settings) -> DataFrame:
    """Only the fitted columns, spread evenly and ordered the same way on every run.

    Row sampling follows the partitioning, so ``fit_partitions`` is part of the model's
    settings: the same rows and settings give the same model on any cluster. Hashing the
    unique (client, day) key spreads even one dominant client over all partitions.
    """
    keyed = train.select(CLIENT, DATE, TARGET, *features)
    spread = keyed.repartition(settings.fit_partitions, CLIENT, DATE)
    return spread.sortWithinPartitions(CLIENT, DATE)


def fit_forecaster(
    train: DataFrame, features: Sequence[str], settings: Settings = Settings()
) -> PipelineModel:
    """Fit on the training part; this runs the fit's jobs.

    Flags must be filled (see ``fill_flags``). Without a number of partitions the rows are
    counted to find it.
    """
    if settings.fit_partitions is None:
        settings = fit_layout(train.count(), settings)
    pipeline = Pipeline(stages=[assembler(features), regressor(settings)])
    return pipeline.fit(_training_layout(train, features, settings))


def forecast(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the predicted log uplift and the predicted volume; a baseline that is missing or not
    positive fails the plan."""
    scored = model.transform(df).drop(VECTOR)
    return restore_volume(scored, PREDICTED_LOG, PREDICTED_VOLUME, guarded=True)


def naive_forecast(df: DataFrame) -> DataFrame:
    """Predict no uplift: the volume equals the baseline."""
    return df.withColumns({PREDICTED_LOG: F.lit(0.0), PREDICTED_VOLUME: F.col(BASELINE)})


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
