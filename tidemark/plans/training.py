"""One governed training run from source to report.

Row data never reaches the driver. What several later steps read is staged once; the
driver sees row counts, check counts and one-row verdicts.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession

from tidemark.config import Settings
from tidemark.errors import EmptyTable
from tidemark.operators.clients import restrict_clients
from tidemark.operators.cohorts import cohort_cutpoints, cohort_ledger, gate_verdict, label_cohorts
from tidemark.operators.features import feature_columns
from tidemark.operators.governance import RUN_MODES, RUN_SCHEMA, decide_promotion, process_gates
from tidemark.operators.guardrail import counted_guardrail, enforce_guardrail
from tidemark.operators.metrics import evaluation
from tidemark.operators.model import fit_forecaster, fit_layout, forecast, save_model
from tidemark.operators.refine import observed_refine
from tidemark.operators.report import build_report, judge_report, run_evidence
from tidemark.operators.split import part_rows, require_all_parts, split_bounds
from tidemark.operators.validate import enforce_counts
from tidemark.plans.forecast import prepare
from tidemark.sinks import (
    record,
    run_metrics,
    run_parameters,
    write_config,
    write_ledger,
    write_report,
)
from tidemark.sources import load, project_canonical, require_rows, source_kind
from tidemark.staging import stage


@dataclass(frozen=True)
class TrainingRun:
    run_id: str
    features: list[str]
    split_sizes: dict[str, int]
    model: PipelineModel
    guardrail: DataFrame
    scored: DataFrame
    evaluation: DataFrame
    ledger: DataFrame
    decision: DataFrame
    report: DataFrame


def _now() -> datetime:
    return datetime.now(timezone.utc)


def run_training(
    spark: SparkSession,
    source: str,
    out_dir: str,
    settings: Settings = Settings(),
    *,
    champions: DataFrame | None = None,
    filter_clients: bool = False,
    mode: str = "production",
    run_id: str | None = None,
) -> TrainingRun:
    """Load, refine, fit, judge and record one run below ``out_dir``.

    The volumetric guardrail stops runs over catalog tables only. Recording a run under a
    ``run_id`` that was recorded before replaces its records.
    """
    mode = mode.strip().lower()
    if mode not in RUN_MODES:
        raise ValueError(f"Run mode must be one of {RUN_MODES}.")
    started = _now()
    run_id = run_id or uuid4().hex
    kind = source_kind(source)

    rows = load(spark, source)
    if champions is not None or filter_clients:
        rows = restrict_clients(
            project_canonical(require_rows(rows, f"{source} is empty."), settings), champions, settings
        )
    # The one pass over the source also counts what it drops and what the checks find.
    observed, seen, checked = observed_refine(rows, settings)
    refined = stage(observed, "refined")
    drops, counts = Row(**seen.get), checked.get
    if not drops.total_rows:
        raise EmptyTable(f"{source} is empty.", source)
    if not counts["valid_rows"]:
        raise EmptyTable(f"Refinement removed every row of {source}.", source, drops.total_rows)
    volume = counted_guardrail(spark, counts["valid_rows"], settings)
    if kind == "table":
        enforce_guardrail(volume)
    enforce_counts(counts)

    prepared = prepare(refined, settings)
    bounds = split_bounds(refined, settings)
    features = feature_columns(prepared.columns, settings.feature_columns)
    sizes = require_all_parts(prepared)
    settings = fit_layout(sizes["train"], settings)
    train = part_rows(prepared, bounds, "train")
    ready = _now()

    model = fit_forecaster(train, features, settings)
    scored = stage(forecast(model, part_rows(prepared, bounds, "val", "test")), "scored")
    accuracy = stage(evaluation(scored), "evaluation")
    cutpoints = stage(cohort_cutpoints(train, settings), "cutpoints")
    test = label_cohorts(part_rows(scored, bounds, "test"), cutpoints, settings)
    ledger = stage(cohort_ledger(test, settings), "ledger")
    save_model(model, f"{out_dir}/models/{run_id}")
    finished = _now()

    judged = (
        run_id, settings.model_name, settings.dataset_version, started, ready, finished,
        False, True, None,
    )
    gated = process_gates(spark.createDataFrame([judged], RUN_SCHEMA), settings)
    decision = stage(
        decide_promotion(gated, accuracy, gate_verdict(ledger), settings, mode), "decision"
    )
    report = build_report(
        judge_report(decision, settings), ledger, settings,
        source=source, evidence=run_evidence(drops, sizes, len(features)),
    )

    parameters = run_parameters(
        decision, settings, source=source, source_kind=kind, feature_count=len(features)
    )
    record(run_metrics(decision), f"{out_dir}/run_metrics", run_id)
    record(parameters, f"{out_dir}/run_params", run_id)
    write_ledger(ledger, f"{out_dir}/ledgers/{run_id}")
    write_config(spark, settings, f"{out_dir}/configs/{run_id}")
    write_report(report, f"{out_dir}/reports", run_id)
    return TrainingRun(
        run_id, features, sizes, model, volume, scored, accuracy, ledger, decision, report
    )
