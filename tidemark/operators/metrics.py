"""Forecast accuracy by split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.config import ACTUAL, BASELINE, TARGET
from tidemark.functions.expressions import smape, smape_term
from tidemark.operators.model import PREDICTED_LOG, PREDICTED_VOLUME

_SPACES = {
    "smape_target": (TARGET, PREDICTED_LOG),
    "smape_volume": (ACTUAL, PREDICTED_VOLUME),
    "smape_naive": (ACTUAL, BASELINE),
}


def smape_by_split(scored: DataFrame) -> DataFrame:
    """Row-level SMAPE per split in log space, in volume space, and of the naive forecast."""
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("row_count"),
        *[smape(F.col(a), F.col(p)).alias(name) for name, (a, p) in _SPACES.items()],
    )


def evaluation(scored: DataFrame) -> DataFrame:
    """The run's five accuracy figures as exactly one row."""

    def within(part: str, space: str) -> Column:
        actual, predicted = _SPACES[space]
        term = F.when(F.col("split") == part, smape_term(F.col(actual), F.col(predicted)))
        return F.avg(term) * F.lit(100.0)

    return scored.agg(
        within("val", "smape_target").alias("val_smape_target"),
        within("test", "smape_target").alias("test_smape_target"),
        within("val", "smape_volume").alias("val_smape_volume"),
        within("test", "smape_volume").alias("test_smape_volume"),
        within("test", "smape_naive").alias("naive_test_smape_volume"),
    )
