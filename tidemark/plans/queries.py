"""Registered queries: each runs one or more operators over the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.config import ACTUAL, BASELINE, CLIENT, DATE, TARGET, Settings
from tidemark.errors import GuardError
from tidemark.functions.expressions import safe_date, safe_double
from tidemark.operators import cohorts, governance, report, split, validate
from tidemark.operators.baseline import rolling_baseline
from tidemark.operators.clients import active_rows, champion_rows, client_medians
from tidemark.operators.features import (
    add_calendar_parts,
    add_cyclical_features,
    add_uplift_target,
    feature_columns,
    restore_volume,
)
from tidemark.operators.guardrail import enforce_guardrail, guardrail as volume_guardrail
from tidemark.operators.metrics import evaluation, smape_by_split
from tidemark.operators.model import (
    VECTOR,
    assembler,
    fit_forecaster,
    forecast,
    load_model,
    naive_forecast,
    save_model,
)
from tidemark.operators.refine import cutoff_date, drop_counts, observed_refine, refine
from tidemark.plans.forecast import prepare, refined_client_days
from tidemark.sinks import (
    read_config,
    record,
    run_metrics,
    run_parameters,
    write_config,
    write_history,
    write_ledger,
    write_report,
)
from tidemark.sources import load, project_canonical, require_rows
from tidemark.sources.warehouse import (
    champions,
    customer_daily,
    daily_volume,
    event_runs,
    text_shipments,
)
from tidemark.staging import stage, stage_path

AS_OF = date(2001, 11, 4)
SETTINGS = Settings(as_of=AS_OF, min_client_median=30.0, max_eval_hours=12.0)
GBT_SETTINGS = Settings(as_of=AS_OF)
#: A short fit, for what holds of a model whatever its trees.
ROUNDTRIP_SETTINGS = Settings(as_of=AS_OF, trees=3, depth=4)
#: Units taken off volumes and baselines to break the checks.
SHORTFALL = 30
# Guardrail expectations as tenths of the client-days inside the lookback.
EXPECTED_TENTHS = (0, 10, 15, 30)
# Lookbacks of the sufficiency check; the last two are shorter than the test windows.
LOOKBACKS = (730, 70, 30)

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, columns: Iterable[str], digits: int) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name), digits) for name in columns})


def _baselined(spark: SparkSession, folder: str) -> DataFrame:
    return rolling_baseline(daily_volume(spark, folder), SETTINGS)


def _refined(spark: SparkSession, folder: str) -> DataFrame:
    return stage(refined_client_days(spark, folder, SETTINGS), "refined")


def _scored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The naive forecast over the prepared client-days, and the bounds of the split."""
    refined = _refined(spark, folder)
    return naive_forecast(prepare(refined, SETTINGS)), split.split_bounds(refined, SETTINGS)


def _train_and_test_cohorts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Scored validation and test rows, and the labelled test rows."""
    scored, bounds = _scored(spark, folder)
    cutpoints = cohorts.cohort_cutpoints(split.part_rows(scored, bounds, "train"), SETTINGS)
    test = split.part_rows(scored, bounds, "test")
    judged = split.part_rows(scored, bounds, "val", "test")
    return judged, cohorts.label_cohorts(test, cutpoints, SETTINGS)


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.cohort_ledger(_train_and_test_cohorts(spark, folder)[1], SETTINGS)


def _gated_runs(spark: SparkSession, folder: str) -> DataFrame:
    return governance.process_gates(event_runs(spark, folder, SETTINGS), SETTINGS)


def _decided(
    spark: SparkSession, folder: str, staged: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Decided runs and the ledger, which is written first where both are read."""
    scored, test = _train_and_test_cohorts(spark, folder)
    ledger = cohorts.cohort_ledger(test, SETTINGS)
    if staged:
        ledger = stage(ledger, "ledger")
    accuracy = evaluation(scored)
    decided = governance.decide_promotion(
        _gated_runs(spark, folder), accuracy, cohorts.gate_verdict(ledger), SETTINGS
    )
    return decided, ledger


def _reported(
    spark: SparkSession, folder: str, staged: bool = False
) -> tuple[DataFrame, DataFrame]:
    decided, ledger = _decided(spark, folder, staged)
    return report.judge_report(decided, SETTINGS), ledger


# Sources


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{stage_path(spark, 'client-days')}.csv"
    _baselined(spark, folder).write.option("header", True).csv(path)
    return refine(load(spark, path), SETTINGS)


def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    name = f"default.client_days_{uuid4().hex}"
    path = stage_path(spark, "client-days")
    _baselined(spark, folder).write.option("path", path).saveAsTable(name)
    try:
        return refine(load(spark, name), SETTINGS)
    finally:
        # The result reads the external files; the catalog keeps no trace of the query.
        spark.sql(f"DROP TABLE {name}")


def _history(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{stage_path(spark, 'history')}.parquet"
    write_history(_baselined(spark, folder), path)
    return load(spark, path)


def history_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The lookback over a history in folders by month."""
    return refine(_history(spark, folder), SETTINGS)


def history_test_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The test window of a whole history, by the bounds that its own last date gives."""
    history = _history(spark, folder)
    bounds = split.split_bounds(history, SETTINGS)
    return split.part_rows(history, bounds, "test").select(CLIENT, DATE, ACTUAL)


def alias_projection(spark: SparkSession, folder: str) -> DataFrame:
    source = _baselined(spark, folder).select(
        F.col(CLIENT),
        F.col(DATE).alias("DATE_DATE"),
        F.col(ACTUAL).alias("PARCEL_VOLUME"),
        F.col(BASELINE).alias("median_4wk_volume"),
        F.col("is_china").alias("china_flag"),
    )
    return project_canonical(source, SETTINGS)


def coercion(spark: SparkSession, folder: str) -> DataFrame:
    rows = text_shipments(spark, folder)
    types = {field.name: field.dataType for field in rows.schema.fields}
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        safe_date(F.col("preadvice_date"), types["preadvice_date"], SETTINGS.date_formats).alias(DATE),
        safe_double(F.col("parcel_volume"), types["parcel_volume"]).alias(ACTUAL),
    )


def event_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags as found in the wild: mixed case, text, fractions, wide values, gaps."""
    wild = _baselined(spark, folder).select(
        "*",
        F.when(F.col(ACTUAL) % 3 != 0, (F.col(ACTUAL) + 0.7).cast("string")).alias("EVENT_WIDE"),
        F.when(F.col("is_china") == 1, F.lit("yes")).otherwise("1").alias("event_Text"),
        F.array(F.col(DATE)).alias("events"),
    )
    rows = project_canonical(wild, SETTINGS)
    return rows.select(CLIENT, *[name for name in rows.columns if name.startswith("event_")])


# Clients and baseline


def champion_clients(spark: SparkSession, folder: str) -> DataFrame:
    return champion_rows(daily_volume(spark, folder), champions(spark, folder)).select(
        CLIENT, DATE, ACTUAL
    )


def median_volumes(spark: SparkSession, folder: str) -> DataFrame:
    return client_medians(customer_daily(spark, folder))


def active_client_rows(spark: SparkSession, folder: str) -> DataFrame:
    return active_rows(customer_daily(spark, folder), SETTINGS).select(CLIENT, DATE, ACTUAL)


# Refinement, guardrail, validation


def refine_drop_counts(spark: SparkSession, folder: str) -> DataFrame:
    return drop_counts(_baselined(spark, folder), SETTINGS)


def observed_refinement(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the dropped rows and of all checks, taken while the kept rows are written."""
    rows, seen, checked = observed_refine(_baselined(spark, folder), SETTINGS)
    stage(rows, "refined")
    counts = {**seen.get, **checked.get}
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} long" for name in counts))


def guard_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """What every guard does with rows that pass and rows that fail: the error, its subject and
    how many rows it counts."""
    based, refined = stage(_baselined(spark, folder), "client-days"), _refined(spark, folder)
    low_actual = refined.withColumn(ACTUAL, F.col(ACTUAL) - SHORTFALL)
    low_baseline = refined.withColumn(BASELINE, F.col(BASELINE) - SHORTFALL)
    unknown = refined.withColumn(ACTUAL, F.when(F.col("is_china") == 0, F.col(ACTUAL)))
    valid = refined.count()
    short = replace(SETTINGS, lookback_days=LOOKBACKS[-1])
    recent = split.label_split(stage(refine(based, short), "refined"), short)

    def volume(expected: int) -> Callable[[], str | None]:
        verdict = volume_guardrail(refined, replace(SETTINGS, expected_rows=expected))
        return lambda: enforce_guardrail(verdict)

    cases = {
        ("columns", "complete"): lambda: project_canonical(based, SETTINGS) and None,
        ("columns", "no actual"): lambda: project_canonical(based.drop(ACTUAL), SETTINGS) and None,
        ("rows", "some"): lambda: require_rows(based, "client-days") and None,
        ("rows", "none"): lambda: require_rows(based.filter(F.col(CLIENT) == ""), "client-days") and None,
        ("input", "refined"): lambda: validate.validate_input(refined),
        ("input", "raw"): lambda: validate.validate_input(based),
        ("input", "low actual"): lambda: validate.validate_input(low_actual),
        ("input", "low baseline"): lambda: validate.validate_input(low_baseline),
        ("input", "no baseline"): lambda: validate.validate_input(refined.drop(BASELINE)),
        ("target", "refined"): lambda: validate.validate_target_input(refined),
        ("target", "unknown actual"): lambda: validate.validate_target_input(unknown),
        ("target", "low actual"): lambda: validate.validate_target_input(low_actual),
        ("inverse", "refined"): lambda: validate.validate_inverse_input(refined),
        ("inverse", "raw"): lambda: validate.validate_inverse_input(based),
        ("inverse", "low baseline"): lambda: validate.validate_inverse_input(low_baseline),
        ("volume", "as expected"): volume(valid),
        ("volume", "a tenth short"): volume(valid * 10 // 9 + 1),
        ("volume", "half and more short"): volume(valid * 3),
        ("history", "two years"): lambda: split.require_all_parts(split.label_split(refined, SETTINGS)) and None,
        ("history", "a month"): lambda: split.require_all_parts(recent) and None,
    }
    outcomes = []
    for (guard, case), call in cases.items():
        try:
            outcomes.append((guard, case, "passed", call() or "", None))
        except GuardError as error:
            outcomes.append((guard, case, type(error).__name__, error.subject, error.rows))
    return spark.createDataFrame(
        outcomes, "guard string, given string, outcome string, subject string, failing_rows long"
    )


def guardrail(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on the refined rows under several expectations."""
    refined = _refined(spark, folder)
    candidates = _baselined(spark, folder).filter(
        F.col(DATE).between(cutoff_date(SETTINGS), F.lit(AS_OF))
    )
    inside = candidates.count()
    verdicts = [
        volume_guardrail(refined, replace(SETTINGS, expected_rows=inside * tenths // 10))
        for tenths in EXPECTED_TENTHS
    ]
    return _rounded(reduce(DataFrame.unionByName, verdicts), ["drop_frac"], 9)


def split_sufficiency(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by part, and whether all parts have some, for a long and two short lookbacks."""
    checked = []
    for days in LOOKBACKS:
        settings = replace(SETTINGS, lookback_days=days)
        labelled = split.label_split(
            stage(refined_client_days(spark, folder, settings), "refined"), settings
        )
        counts = {f"{part}_rows": F.count_if(F.col("split") == part) for part in split.PARTS}
        counted = labelled.agg(*[count.alias(name) for name, count in counts.items()])
        enough = F.least(*counts) > 0
        checked.append(counted.select(F.lit(days).alias("lookback_days"), "*", enough.alias("sufficient")))
    return reduce(DataFrame.unionByName, checked)


def violations(spark: SparkSession, folder: str) -> DataFrame:
    rows = project_canonical(text_shipments(spark, folder), SETTINGS)
    rows = rows.withColumn(ACTUAL, F.col(ACTUAL) - 3)
    checks = {
        f"{kind}_{name}": bad
        for kind, group in (
            ("input", validate.input_checks()),
            ("target", validate.target_checks()),
            ("inverse", validate.inverse_checks()),
        )
        for name, bad in group.items()
    }
    return validate.violations(rows, checks)


# Features, target, split


def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    return add_calendar_parts(daily_volume(spark, folder).select(CLIENT, DATE))


def cyclical_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = add_cyclical_features(daily_volume(spark, folder).select(CLIENT, DATE))
    waves = [name for name in rows.columns if name.endswith(("_sin", "_cos"))]
    return _rounded(rows.select(CLIENT, DATE, *waves), waves, 9)


def _with_uplift(spark: SparkSession, folder: str) -> DataFrame:
    known = _baselined(spark, folder).filter(F.col(BASELINE) > 0)
    return add_uplift_target(known, SETTINGS).select(CLIENT, DATE, ACTUAL, BASELINE, TARGET)


def uplift_target(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_with_uplift(spark, folder), [TARGET], 9)


def uplift_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    restored = restore_volume(_with_uplift(spark, folder), TARGET, "restored_volume", guarded=True)
    return _rounded(restored, ["restored_volume"], 6).drop(TARGET)


def split_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_bounds(refined_client_days(spark, folder, SETTINGS), SETTINGS)


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_counts(split.label_split(_refined(spark, folder), SETTINGS))


def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    labelled = split.label_split(_refined(spark, folder), SETTINGS)
    return split.in_date_order(labelled.select(CLIENT, DATE, "split"))


# Evaluation and cohorts


def naive_smape_by_split(spark: SparkSession, folder: str) -> DataFrame:
    result = smape_by_split(_scored(spark, folder)[0])
    return _rounded(result, ["smape_target", "smape_volume", "smape_naive"], 6)


def run_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    result = evaluation(_scored(spark, folder)[0])
    return _rounded(result, result.columns, 6)


def cohort_cutpoints(spark: SparkSession, folder: str) -> DataFrame:
    train = split.part_rows(*_scored(spark, folder), "train")
    return _rounded(cohorts.cohort_cutpoints(train, SETTINGS), cohorts.CUTS, 9)


def cohort_rows(spark: SparkSession, folder: str) -> DataFrame:
    labelled = _train_and_test_cohorts(spark, folder)[1]
    return labelled.select(CLIENT, DATE, ACTUAL, BASELINE, "archetype")


def cohort_daily(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.cohort_daily(_train_and_test_cohorts(spark, folder)[1])


def cohort_ledger(spark: SparkSession, folder: str) -> DataFrame:
    ledger = cohorts.ledger_rows(_ledger(spark, folder))
    return _rounded(ledger, ["business_smape"], 6)


def cohort_briefing(spark: SparkSession, folder: str) -> DataFrame:
    return report.cohort_briefing(_ledger(spark, folder))


def ledger_json(spark: SparkSession, folder: str) -> DataFrame:
    ledger = _ledger(spark, folder)
    path = stage_path(spark, "ledger-json")
    write_ledger(ledger, path)
    stored = spark.read.schema(cohorts.ledger_rows(ledger).schema).json(path)
    return _rounded(stored, ["business_smape"], 6)


def gate_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return cohorts.gate_verdict(_ledger(spark, folder))


# Governance and report


def run_hours(spark: SparkSession, folder: str) -> DataFrame:
    return governance.run_hours(event_runs(spark, folder, SETTINGS)).select(
        "run_id", "hours_to_baseline", "hours_to_evaluation", "artifact_completeness"
    )


def run_gates(spark: SparkSession, folder: str) -> DataFrame:
    return _gated_runs(spark, folder).select("run_id", *governance.GATES, "process_pass")


def promotion_rate(spark: SparkSession, folder: str) -> DataFrame:
    rate = governance.promotion_rate(event_runs(spark, folder, SETTINGS))
    return _rounded(rate, ["promotion_rate"], 9)


def drift_latency(spark: SparkSession, folder: str) -> DataFrame:
    runs = governance.drift_latency(event_runs(spark, folder, SETTINGS), "experiment_start")
    return runs.select("run_id", "drift_latency_hours")


def promotion_decision(spark: SparkSession, folder: str) -> DataFrame:
    return _decided(spark, folder)[0].select(
        "run_id",
        "cohorts_pass",
        "quality_pass",
        "process_pass",
        "promotion_recommendation",
        "promotion_block_reason",
        "is_blocking",
    )


def _recorded_twice(records: DataFrame, label: str) -> DataFrame:
    """A batch recorded beside another one and then once more, read back: one copy is left."""
    spark = records.sparkSession
    path = stage_path(spark, label)
    staged = stage(records, label)
    for batch in ("again", "other", "again"):
        record(staged, path, batch)
    return spark.read.parquet(path).filter("batch = 'again'").select(*records.columns)


def run_metrics_long(spark: SparkSession, folder: str) -> DataFrame:
    stored = _recorded_twice(run_metrics(_decided(spark, folder)[0]), "run-metrics")
    shown = F.when(F.col("key").contains("smape"), F.round("value", 6)).otherwise(F.col("value"))
    return stored.withColumn("value", shown)


def run_params_long(spark: SparkSession, folder: str) -> DataFrame:
    settings = replace(SETTINGS, fit_partitions=16)
    records = run_parameters(
        _decided(spark, folder)[0], settings, source="lineitem", source_kind="parquet"
    )
    return _recorded_twice(records, "run-params")


def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """The reports as written to JSON and read back, flattened."""
    reported, ledger = _reported(spark, folder, staged=True)
    built = report.build_report(reported, ledger, SETTINGS, source="lineitem")
    path = stage_path(spark, "reports")
    for _ in range(2):
        write_report(built, path, "events")
    stored = spark.read.schema(built.schema).json(path)

    def performance(name: str) -> Column:
        return F.round(F.col(f"key_metrics.performance.{name}"), 6).alias(name)

    return stored.select(
        "report_name",
        *[F.col(f"executive_summary.{name}").alias(name) for name in ("phase", "objective", "run_id")],
        F.col("recommendation.explanation").alias("explanation"),
        F.col("executive_summary.recommendation").alias("recommendation"),
        *[performance(name) for name in report.PERFORMANCE],
        F.col("key_metrics.cmmi.cmmi_hours_to_baseline").alias("hours_to_baseline"),
        F.col("key_metrics.thresholds.cmmi_max_evaluation_hours").alias("max_evaluation_hours"),
        F.size("operational_archetype_briefing").alias("cohort_count"),
        F.col("operational_archetype_briefing")[0]["row_count"].alias("anchor_rows"),
        F.col("promotion_context.promotion_block_reason").alias("promotion_block_reason"),
        F.col("config_snapshot")["MAX_DIAL_SMAPE"].alias("max_dial_smape"),
        F.col("gates.quality_pass").alias("quality_pass"),
        F.col("gates.cmmi_pass").alias("process_pass"),
    )


def config_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A run's settings as stored and read back; the expected rows are those of the history."""
    settings = replace(SETTINGS, expected_rows=daily_volume(spark, folder).count())
    path = stage_path(spark, "config")
    write_config(spark, settings, path)
    return read_config(spark, path)


def run_stages(spark: SparkSession, folder: str) -> DataFrame:
    """With the evidence that the refined and prepared rows give."""
    drops = drop_counts(_baselined(spark, folder), SETTINGS).first()
    prepared = prepare(_refined(spark, folder), SETTINGS)
    sizes = split.require_all_parts(prepared)
    evidence = report.run_evidence(drops, sizes, len(feature_columns(prepared.columns)))
    return report.stage_summary(_reported(spark, folder)[0], evidence)


def run_gate_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return report.gate_snapshot(_reported(spark, folder)[0], SETTINGS)


# Model


def model_features(spark: SparkSession, folder: str) -> DataFrame:
    """The assembled vector of every row, flattened to one row per inferred feature."""
    prepared = prepare(_refined(spark, folder), SETTINGS)
    names = feature_columns(prepared.columns)
    vectors = assembler(names).transform(prepared).select(
        CLIENT, DATE, F.posexplode(vector_to_array(F.col(VECTOR))).alias("place", "value")
    )
    feature = F.array(*[F.lit(name) for name in names])[F.col("place")].alias("feature")
    return _rounded(vectors.select(CLIENT, DATE, feature, "value"), ["value"], 9)


def gbt_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Fit, save, reload and score validation and test rows."""
    refined = _refined(spark, folder)
    bounds = split.split_bounds(refined, GBT_SETTINGS)
    prepared = prepare(refined, GBT_SETTINGS)
    features = feature_columns(prepared.columns)
    train = split.part_rows(prepared, bounds, "train")
    model = fit_forecaster(train, features, GBT_SETTINGS)
    path = stage_path(spark, "model")
    save_model(model, path)
    scored = forecast(load_model(path), split.part_rows(prepared, bounds, "val", "test"))
    return scored.select(CLIENT, DATE, "split", ACTUAL, "pred_log", "pred_volume")


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """What holds of any fitted model: the rows that it scores, that the volume is the restored
    log uplift, and that the saved model scores them the same."""
    refined = _refined(spark, folder)
    bounds = split.split_bounds(refined, ROUNDTRIP_SETTINGS)
    prepared = prepare(refined, ROUNDTRIP_SETTINGS)
    features = feature_columns(prepared.columns)
    model = fit_forecaster(split.part_rows(prepared, bounds, "train"), features, ROUNDTRIP_SETTINGS)
    path = stage_path(spark, "model")
    save_model(model, path)
    rest = split.part_rows(prepared, bounds, "val", "test")
    restored = F.exp("pred_log") * F.col(BASELINE)
    scored = forecast(model, rest).withColumn("first_log", F.col("pred_log")).drop("pred_log", "pred_volume")
    return forecast(load_model(path), scored).select(
        CLIENT,
        DATE,
        "split",
        ACTUAL,
        (F.abs(F.col("pred_volume") - restored) <= 1e-9 * restored).alias("volume_restored"),
        (F.col("pred_log") == F.col("first_log")).alias("reloaded_equal"),
        F.col("pred_log").between(-14, 14).alias("in_range"),
    )


QUERIES: dict[str, Query] = {
    "daily_volume": daily_volume,
    "rolling_baseline": _baselined,
    "csv_scan": csv_scan,
    "table_scan": table_scan,
    "history_rows": history_rows,
    "history_test_rows": history_test_rows,
    "alias_projection": alias_projection,
    "coercion": coercion,
    "event_flags": event_flags,
    "champion_clients": champion_clients,
    "client_medians": median_volumes,
    "active_clients": active_client_rows,
    "refined_rows": lambda spark, folder: refined_client_days(spark, folder, SETTINGS),
    "refine_drop_counts": refine_drop_counts,
    "observed_refinement": observed_refinement,
    "guard_outcomes": guard_outcomes,
    "guardrail": guardrail,
    "violations": violations,
    "calendar_parts": calendar_parts,
    "cyclical_features": cyclical_features,
    "uplift_target": uplift_target,
    "uplift_roundtrip": uplift_roundtrip,
    "split_bounds": split_bounds,
    "split_counts": split_counts,
    "split_sufficiency": split_sufficiency,
    "model_features": model_features,
    "split_rows": split_rows,
    "naive_smape_by_split": naive_smape_by_split,
    "run_accuracy": run_accuracy,
    "cohort_cutpoints": cohort_cutpoints,
    "cohort_rows": cohort_rows,
    "cohort_daily": cohort_daily,
    "cohort_ledger": cohort_ledger,
    "cohort_briefing": cohort_briefing,
    "ledger_json": ledger_json,
    "gate_verdict": gate_verdict,
    "promotion_decision": promotion_decision,
    "run_hours": run_hours,
    "run_gates": run_gates,
    "promotion_rate": promotion_rate,
    "drift_latency": drift_latency,
    "run_metrics_long": run_metrics_long,
    "run_params_long": run_params_long,
    "run_report": run_report,
    "config_snapshot": config_snapshot,
    "run_stages": run_stages,
    "run_gate_snapshot": run_gate_snapshot,
    "model_roundtrip": model_roundtrip,
    "gbt_forecast": gbt_forecast,
}
