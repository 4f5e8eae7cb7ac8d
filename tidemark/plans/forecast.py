"""Shared steps of the forecasting jobs."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.config import Settings
from tidemark.operators.baseline import rolling_baseline
from tidemark.operators.features import add_cyclical_features, add_uplift_target, fill_flags
from tidemark.operators.refine import refine
from tidemark.operators.split import label_split
from tidemark.sources.warehouse import daily_volume


def resolved(spark: SparkSession, settings: Settings) -> Settings:
    """Settings with a date: the session's current one, read once, where none is given."""
    if settings.as_of is not None:
        return settings
    return replace(settings, as_of=spark.range(1).select(F.current_date()).first()[0])


def warehouse_client_days(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    """Client-days with baselines for the lookback, reading no older shipments than needed.

    The first kept day still sees its whole baseline window, so the refined rows equal
    those of the full history.
    """
    as_of = resolved(spark, settings).as_of
    history = timedelta(days=settings.lookback_days + settings.baseline_window_days)
    until = as_of if settings.bound_above else None
    return rolling_baseline(daily_volume(spark, folder, as_of - history, until), settings)


def refined_client_days(spark: SparkSession, folder: str, settings: Settings) -> DataFrame:
    settings = resolved(spark, settings)
    return refine(warehouse_client_days(spark, folder, settings), settings)


def add_model_inputs(refined: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Flags, calendar features and target; row-wise, so it also runs on a stream."""
    return add_uplift_target(add_cyclical_features(fill_flags(refined)), settings)


def prepare(refined: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Model inputs plus the split label; ``refined`` is read twice, so stage it first."""
    return add_model_inputs(label_split(refined, settings), settings)
