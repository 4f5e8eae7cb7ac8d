"""Volumetric guardrail: judge the refined row count against the expected one."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.config import ZONE_CRITICAL, ZONE_NOMINAL, ZONE_WARNING, Settings
from tidemark.errors import VolumeRejected

# Failure reasons.
STARVATION = "CRITICAL: DataStarvationError"
LOW_QUALITY = "CRITICAL: DataQualityError"
DEVIATION = "WARNING: ApprovedSchemaDeviation"

logger = logging.getLogger(__name__)


def judge_volume(counts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add the verdict to rows of ``valid_rows, expected_row_count``; top condition wins."""
    valid, expected = F.col("valid_rows"), F.col("expected_row_count")
    drop = F.coalesce(F.lit(1.0) - F.try_divide(valid, expected), F.lit(1.0))
    starved = valid < expected * F.lit(settings.min_row_fraction)
    low_quality = drop > F.lit(settings.max_drop_fraction)
    nominal = drop <= F.lit(settings.nominal_drop_fraction)
    critical = starved | low_quality
    return counts.select(
        (~critical).alias("passed"),
        F.when(starved, STARVATION)
        .when(low_quality, LOW_QUALITY)
        .when(~nominal, DEVIATION)
        .alias("failure_reason"),
        drop.alias("drop_frac"),
        valid.cast("bigint").alias("valid_rows"),
        expected.cast("bigint").alias("expected_row_count"),
        F.when(critical, ZONE_CRITICAL)
        .when(nominal, ZONE_NOMINAL)
        .otherwise(ZONE_WARNING)
        .alias("workflow_impact_flag"),
    )


def guardrail(refined: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The one-row verdict on a refined table."""
    return _judged(refined.agg(F.count(F.lit(1)).alias("valid_rows")), settings)


def counted_guardrail(
    spark: SparkSession, valid_rows: int, settings: Settings = Settings()
) -> DataFrame:
    """The same verdict from a count taken before."""
    return _judged(spark.range(1).select(F.lit(valid_rows).cast("bigint").alias("valid_rows")), settings)


def _judged(counted: DataFrame, settings: Settings) -> DataFrame:
    expected = F.lit(settings.expected_rows).cast("bigint").alias("expected_row_count")
    return judge_volume(counted.select("valid_rows", expected), settings)


def enforce_guardrail(verdict: DataFrame) -> str | None:
    """Stop the run on a critical verdict, warn on a deviation and return its reason."""
    row = verdict.first()
    if not row.passed:
        message = f"Volume guardrail failed: {row.failure_reason}"
        raise VolumeRejected(message, row.failure_reason, row.valid_rows)
    if row.failure_reason is not None:
        logger.warning("%s: %s, drop %.4f", row.workflow_impact_flag, row.failure_reason, row.drop_frac)
    return row.failure_reason
