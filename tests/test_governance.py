from datetime import datetime, timedelta

import pytest

from tidemark.config import Settings
from tidemark.operators.governance import (
    RUN_SCHEMA,
    decide_promotion,
    drift_latency,
    process_gates,
    promotion_rate,
)
from tidemark.operators.report import gate_snapshot, judge_report, stage_summary

START = datetime(2026, 3, 29, 0, 30)
PASSING = ("r", 1.0, 8.0, False, True)


def _runs(spark, *runs, ntz=False):
    rows = [
        (run_id, "m", "v1", START, START + timedelta(hours=ready), START + timedelta(hours=done),
         promoted, complete, START + timedelta(hours=5) if promoted else None)
        for run_id, ready, done, promoted, complete in runs
    ]
    schema = RUN_SCHEMA.replace("timestamp", "timestamp_ntz") if ntz else RUN_SCHEMA
    return spark.createDataFrame(rows, schema)


def _accuracy(spark, smape):
    return spark.createDataFrame(
        [(1.0, 2.0, 3.0, smape, 5.0)],
        "val_smape_target double, test_smape_target double, val_smape_volume double,"
        " test_smape_volume double, naive_test_smape_volume double",
    )


def _verdict(spark, passes=True, reason=None, warned=False):
    return spark.createDataFrame(
        [(passes, reason, warned, "")],
        "cohorts_pass boolean, block_reason string, deviation_warning boolean,"
        " breached_cohorts string",
    )


@pytest.mark.parametrize("ntz", [False, True])
def test_gates_and_promotion_rate(spark, ntz):
    quick, slow, bare = ("a", 0.25, 17.5, True, True), ("b", 2.5, 40.0, False, True), ("c", 1.75, 23.0, False, False)
    runs = _runs(spark, quick, slow, bare, ntz=ntz)
    a, b, c = process_gates(runs).orderBy("run_id").collect()
    assert (a.hours_to_baseline, a.hours_to_evaluation) == (0.25, 17.5)
    assert [row.process_pass for row in (a, b, c)] == [True, False, False]
    assert [row.baseline_speed_pass for row in (a, b, c)] == [True, False, True]
    assert [row.evaluation_speed_pass for row in (a, b, c)] == [True, False, True]
    assert [row.artifact_completeness for row in (a, b, c)] == [1.0, 1.0, 0.0]
    assert not c.artifact_completeness_pass
    assert promotion_rate(runs).first().promotion_rate == pytest.approx(1 / 3)


def test_limits_are_inclusive(spark):
    assert process_gates(_runs(spark, ("a", 2.0, 24.0, True, True))).first().process_pass
    late = process_gates(_runs(spark, ("a", 2.001, 24.001, True, True))).first()
    assert (late.baseline_speed_pass, late.evaluation_speed_pass) == (False, False)


def test_hours_ignore_daylight_saving(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        runs = _runs(spark, ("a", 1.0, 8.0, True, True), ntz=True)
        assert process_gates(runs).first().hours_to_evaluation == 8.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_no_runs(spark):
    row = promotion_rate(_runs(spark, PASSING).limit(0)).first()
    assert (row.run_count, row.promotion_rate) == (0, 0.0)


def test_drift_latency(spark):
    runs = _runs(spark, ("a", 1.0, 8.0, True, True), ("b", 1.0, 8.0, False, True))
    rows = drift_latency(runs, "experiment_start").orderBy("run_id").collect()
    assert [row.drift_latency_hours for row in rows] == [5.0, None]


@pytest.mark.parametrize(
    ("smape", "verdict", "run", "mode", "quality", "promoted", "reason"),
    [
        (40.0, {}, PASSING, "production", True, True, None),
        (40.1, {}, PASSING, "production", False, False, "CRITICAL: OverallSmapeBreach"),
        (None, {}, PASSING, "production", False, False, "CRITICAL: OverallSmapeBreach"),
        (10.0, {"passes": False, "reason": "R"}, PASSING, "production", False, False, "R"),
        (10.0, {"warned": True}, PASSING, "production", True, True, "WARNING: SpikerVolatility"),
        (41.0, {"warned": True}, PASSING, "production", False, False,
         "CRITICAL: OverallSmapeBreach"),
        (10.0, {}, ("r", 3.0, 8.0, False, True), "production", True, False, None),
        (10.0, {}, PASSING, " Debug ", True, False, None),
    ],
)
def test_decision(spark, smape, verdict, run, mode, quality, promoted, reason):
    gated = process_gates(_runs(spark, run))
    row = decide_promotion(
        gated, _accuracy(spark, smape), _verdict(spark, **verdict), mode=mode
    ).first()
    assert (row.quality_pass, row.promotion_recommendation) == (quality, promoted)
    assert row.promotion_block_reason == reason
    assert row.is_blocking is not quality
    assert row.run_mode == mode.strip().lower()


def test_unknown_mode(spark):
    gated = process_gates(_runs(spark, PASSING))
    with pytest.raises(ValueError, match="Run mode"):
        decide_promotion(gated, _accuracy(spark, 1.0), _verdict(spark), mode="live")


def test_report_quality_ignores_cohorts(spark):
    gated = process_gates(_runs(spark, PASSING))
    decided = decide_promotion(gated, _accuracy(spark, 10.0), _verdict(spark, False, "R"))
    reported = judge_report(decided, Settings())
    row = reported.first()
    assert (row.quality_pass, row.report_quality_pass, row.recommendation) == (
        False, True, "reject",
    )
    stages = stage_summary(reported).collect()
    assert [row.step for row in stages] == list(range(1, 9))
    assert {row.status for row in stages} == {"Pass"}
    assert stages[4].evidence == (
        "test_smape_target=2.0000, val_smape_target=1.0000,"
        " test_smape_volume=10.0000, val_smape_volume=3.0000"
    )
    assert [row.status for row in gate_snapshot(reported).collect()] == [
        "Pass", "Pass", "Pass", "Pass", "Pending",
    ]


def test_partial_stages(spark):
    gated = process_gates(_runs(spark, ("r", 3.0, 8.0, False, True)))
    reported = judge_report(decide_promotion(gated, _accuracy(spark, 50.0), _verdict(spark)))
    partial = [row.stage for row in stage_summary(reported).collect() if row.status == "Partial"]
    assert partial == ["Evaluate", "Compute CMMI metrics"]
    gates = {row.gate: row.status for row in gate_snapshot(reported).collect()}
    assert (gates["quality"], gates["cmmi_process"]) == ("Partial", "Partial")
