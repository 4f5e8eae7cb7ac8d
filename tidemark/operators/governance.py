"""Run governance: process timings, process gates, promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.config import OVERALL_BREACH, Settings
from tidemark.functions.expressions import hours_between, with_row
from tidemark.operators.cohorts import soft_reason

GATES = ("baseline_speed_pass", "evaluation_speed_pass", "artifact_completeness_pass")
RUN_MODES = ("production", "debug")
RUN_SCHEMA = """
    run_id string, model_name string, dataset_version string,
    experiment_start timestamp, baseline_ready timestamp, evaluation_complete timestamp,
    promoted boolean, artifacts_complete boolean, drift_detected_at timestamp
"""


def _hours(df: DataFrame, start: str, end: str) -> Column:
    return hours_between(F.col(start), F.col(end), df.schema[start].dataType)


def run_hours(runs: DataFrame) -> DataFrame:
    """Add hours to baseline, hours to evaluation and the artifact completeness score."""
    return runs.withColumns(
        {
            "hours_to_baseline": _hours(runs, "experiment_start", "baseline_ready"),
            "hours_to_evaluation": _hours(runs, "experiment_start", "evaluation_complete"),
            "artifact_completeness": F.when(F.col("artifacts_complete"), 1.0).otherwise(0.0),
        }
    )


def drift_latency(runs: DataFrame, shift_start: str) -> DataFrame:
    """Add hours from the onset of drift to its detection, NULL when not detected."""
    return runs.withColumn(
        "drift_latency_hours", _hours(runs, shift_start, "drift_detected_at")
    )


def process_gates(runs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add the three process gates (limits inclusive) and whether all of them pass."""
    timed = run_hours(runs).withColumns(
        {
            "baseline_speed_pass": F.col("hours_to_baseline") <= settings.max_baseline_hours,
            "evaluation_speed_pass": F.col("hours_to_evaluation") <= settings.max_eval_hours,
            "artifact_completeness_pass": F.col("artifact_completeness") == 1.0,
        }
    )
    first, second, third = [F.col(gate) for gate in GATES]
    return timed.withColumn("process_pass", first & second & third)


def promotion_rate(runs: DataFrame) -> DataFrame:
    """One row: promoted share of all runs, 0.0 without runs."""
    share = F.avg(F.coalesce(F.col("promoted"), F.lit(False)).cast("int"))
    return runs.agg(
        F.count(F.lit(1)).alias("run_count"), F.coalesce(share, F.lit(0.0)).alias("promotion_rate")
    )


def decide_promotion(
    gated: DataFrame,
    evaluation: DataFrame,
    verdict: DataFrame,
    settings: Settings = Settings(),
    mode: str = "production",
) -> DataFrame:
    """Add the quality verdict, the recommendation and its reason to every run.

    ``evaluation`` and ``verdict`` are one-row frames and enter as scalar subqueries.
    Debug runs are never recommended.
    """
    mode = mode.strip().lower()
    if mode not in RUN_MODES:
        raise ValueError(f"Run mode must be one of {RUN_MODES}.")
    figures = {name: F.col(f"_accuracy.{name}") for name in evaluation.columns}
    quality = F.col("_gate.cohorts_pass") & (F.col("test_smape_volume") <= settings.max_smape)
    attached = with_row(with_row(gated, evaluation, "_accuracy"), verdict, "_gate")
    judged = attached.withColumns(figures).withColumns(
        {
            "cohorts_pass": F.col("_gate.cohorts_pass"),
            "quality_pass": F.coalesce(quality, F.lit(False)),
        }
    )
    quality = F.col("quality_pass")
    decided = judged.withColumns(
        {
            "promotion_recommendation": quality
            & F.col("process_pass")
            & F.lit(mode == "production"),
            "promotion_block_reason": F.coalesce(
                F.col("_gate.block_reason"),
                F.when(~quality, OVERALL_BREACH),
                F.when(F.col("_gate.deviation_warning"), soft_reason(settings)),
            ),
            "is_blocking": ~quality,
            "run_mode": F.lit(mode),
        }
    )
    return decided.drop("_accuracy", "_gate")
