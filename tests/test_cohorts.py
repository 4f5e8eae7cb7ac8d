from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.config import ANCHORS, DIALS, PHANTOMS, SPIKERS, Settings
from tidemark.functions.expressions import smape
from tidemark.operators.cohorts import (
    cohort_cutpoints,
    cohort_ledger,
    gate_verdict,
    label_cohorts,
    ledger_rows,
)
from tidemark.operators.metrics import evaluation, smape_by_split
from tidemark.operators.model import naive_forecast
from tidemark.operators.report import cohort_briefing

ROWS = "event_date date, actual_volume double, rolling_4w_median double, is_china int"
LABELLED = "archetype string, event_date date, actual_volume double, pred_volume double"
DAY = date(2026, 1, 1)


def _cuts(spark, high, low, erratic, steady):
    return spark.createDataFrame(
        [(high, low, erratic, steady)],
        "high_volume_cut double, low_volume_cut double,"
        " low_predictability_cut double, high_predictability_cut double",
    )


@pytest.mark.parametrize(
    ("actual", "baseline", "china", "cohort"),
    [
        (101.0, 100.0, 0, ANCHORS),
        (101.0, 100.0, None, ANCHORS),
        (101.0, 100.0, 1, SPIKERS),
        (110.0, 100.0, 0, ANCHORS),  # exactly on the steady cut
        (150.0, 100.0, 0, SPIKERS),  # exactly on the erratic cut
        (120.0, 100.0, 0, DIALS),
        (50.0, 50.0, 0, DIALS),
        (20.0, 20.0, 1, PHANTOMS),  # exactly on the low volume cut
        (20.0, None, 0, PHANTOMS),
    ],
)
def test_labels(spark, actual, baseline, china, cohort):
    df = spark.createDataFrame([(DAY, actual, baseline, china)], ROWS)
    assert label_cohorts(df, _cuts(spark, 100.0, 20.0, 0.5, 0.1)).first().archetype == cohort


def test_ties_of_both_signal_cuts_are_spikers_and_low_volume_wins(spark):
    df = spark.createDataFrame([(DAY, 100.0, 100.0, 0)], ROWS)
    assert label_cohorts(df, _cuts(spark, 100.0, 20.0, 0.0, 0.0)).first().archetype == SPIKERS
    assert label_cohorts(df, _cuts(spark, 100.0, 100.0, 0.0, 0.0)).first().archetype == PHANTOMS


def test_cutpoints_default_to_the_labelled_rows(spark):
    rows = [(DAY, float(i), 100.0 + i, 0) for i in range(101)]
    df = spark.createDataFrame(rows, ROWS)
    cuts = cohort_cutpoints(df).first()
    assert cuts.high_volume_cut == 175.0
    assert cuts.low_volume_cut == 135.0
    labels = {row.archetype: row["count"] for row in label_cohorts(df).groupBy("archetype").count().collect()}
    assert labels[PHANTOMS] == 36
    assert sum(labels.values()) == 101


def test_smape_value(spark):
    df = spark.createDataFrame([(100.0, 50.0), (0.0, 0.0)], "a double, p double")
    assert df.agg(smape(F.col("a"), F.col("p"))).first()[0] == pytest.approx(100 / 3)


def _ledger(spark, errors, settings=Settings()):
    """One row per cohort and day whose daily SMAPE is the given percentage."""
    rows = [
        (cohort, DAY + timedelta(days=i), 200.0 + percent, 200.0 - percent)
        for cohort, percent in errors.items()
        for i in range(2)
    ]
    return cohort_ledger(spark.createDataFrame(rows, LABELLED), settings)


def test_ledger_sums_by_day_and_always_has_four_rows(spark):
    rows = [
        (DIALS, DAY, 100.0, 130.0),
        (DIALS, DAY, 100.0, 70.0),  # cancels within the day
        (DIALS, DAY + timedelta(days=1), 100.0, 100.0),
    ]
    ledger = ledger_rows(cohort_ledger(spark.createDataFrame(rows, LABELLED)))
    by_name = {row.archetype: row for row in ledger.collect()}
    assert list(by_name) and len(by_name) == 4
    assert by_name[DIALS].row_count == 3
    assert by_name[DIALS].business_smape == 0.0
    assert by_name[ANCHORS].row_count == 0
    assert by_name[ANCHORS].business_smape is None
    assert by_name[ANCHORS].workflow_impact_flag == "ZONE_1_NOMINAL"
    shown = {row.archetype: row.business_smape for row in cohort_briefing(ledger).collect()}
    assert shown == {ANCHORS: "NA", DIALS: "0.0000", SPIKERS: "NA", PHANTOMS: "NA"}


def test_threshold_itself_is_no_breach(spark):
    measured = _ledger(spark, {DIALS: 13.0}).filter(F.col("archetype") == DIALS).first()
    limits = [
        type(cohort)(cohort.name, measured.business_smape, cohort.hard, cohort.reason)
        if cohort.name == DIALS else cohort
        for cohort in Settings().cohorts
    ]
    exact = _ledger(spark, {DIALS: 13.0}, Settings(cohorts=tuple(limits)))
    assert {row.workflow_impact_flag for row in exact.collect()} == {"ZONE_1_NOMINAL"}


@pytest.mark.parametrize(
    ("errors", "passes", "reason", "warned", "breached"),
    [
        ({ANCHORS: 7.0, DIALS: 12.0, SPIKERS: 23.0, PHANTOMS: 31.0}, True, None, False, ""),
        ({ANCHORS: 8.0}, False, "CRITICAL: AnchorToleranceBreach", False, "The Anchors"),
        ({ANCHORS: 8.0, DIALS: 14.0}, False, "CRITICAL: DialToleranceBreach", False,
         "The Anchors, The Dials"),
        ({ANCHORS: 8.0, PHANTOMS: 33.0}, False, "CRITICAL: PhantomToleranceBreach", False,
         "The Anchors, The Phantoms"),
        ({SPIKERS: 25.0}, True, None, True, "The Spikers"),
        ({DIALS: 14.0, SPIKERS: 25.0}, False, "CRITICAL: DialToleranceBreach", True,
         "The Dials, The Spikers"),
    ],
)
def test_verdict(spark, errors, passes, reason, warned, breached):
    row = gate_verdict(_ledger(spark, errors)).first()
    assert (row.cohorts_pass, row.block_reason) == (passes, reason)
    assert (row.deviation_warning, row.breached_cohorts) == (warned, breached)


def test_accuracy_by_split(spark):
    df = spark.createDataFrame(
        [("val", 100.0, 50.0, 0.5), ("test", 30.0, 30.0, 0.0), ("train", 1.0, 9.0, 0.1)],
        "split string, actual_volume double, rolling_4w_median double, target double",
    )
    scored = naive_forecast(df)
    by_split = {row.split: row for row in smape_by_split(scored).collect()}
    assert by_split["val"].smape_volume == pytest.approx(200 / 3)
    assert by_split["val"].smape_target == pytest.approx(200.0)
    assert by_split["test"].smape_naive == 0.0
    row = evaluation(scored).first()
    assert row.val_smape_volume == by_split["val"].smape_volume
    assert (row.test_smape_volume, row.test_smape_target) == (0.0, 0.0)
    assert row.naive_test_smape_volume == 0.0
