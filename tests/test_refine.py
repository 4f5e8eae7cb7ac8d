from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.operators.guardrail import enforce_guardrail, guardrail, judge_volume
from tidemark.operators.refine import drop_counts, refine

TODAY = date(2026, 6, 30)
SETTINGS = Settings(as_of=TODAY)
LIVE = """preadvice_date timestamp, parcel_volume double, median_4wk_volume double,
          target double, china_flag int, domestic_flag int"""
CANONICAL = "event_date date, actual_volume double, rolling_4w_median double, target double"


def _ago(days):
    return TODAY - timedelta(days=days)


def _noon(days):
    return datetime(TODAY.year, TODAY.month, TODAY.day, 12) - timedelta(days=days)


def test_only_complete_recent_rows_survive(spark):
    df = spark.createDataFrame(
        [
            (_noon(731), 64.0, 33.0, None, 1, 1),
            (_noon(365), 7.25, 48.5, -0.4, 0, 0),
            (_noon(9), 810.0, None, 0.0, 0, 1),
            (_noon(0), 12.0, 10.5, 3.0, None, None),
            (None, 55.0, 41.0, 0.3, 1, 1),
            (_noon(30), None, 61.0, 0.0, 0, 1),
        ],
        LIVE,
    )
    rows = refine(df, SETTINGS).orderBy("event_date").collect()
    assert [(row.event_date, row.rolling_4w_median) for row in rows] == [
        (_ago(365), 48.5),
        (_ago(0), 10.5),
    ]


def test_canonical_and_other_date_names(spark):
    rows = [(_ago(40 * i), 3.5 + i, 12.0 * i, None) for i in range(1, 6)] + [(None, 8.0, 77.0, 1.5)]
    df = spark.createDataFrame(rows, CANONICAL)
    assert refine(df, SETTINGS).count() == 5
    assert refine(df.withColumnRenamed("event_date", "DATE_DATE"), SETTINGS).count() == 5


@pytest.mark.parametrize(
    ("row", "kept"),
    [
        ((_ago(730), 1.0, 11.0, None), True),
        ((_ago(731), 1.0, 11.0, None), False),
        ((TODAY, 1.0, 11.0, None), True),
        ((_ago(-1), 1.0, 11.0, None), False),
        ((_ago(1), 0.0, 11.0, None), False),
        ((_ago(1), -1.0, 11.0, None), False),
        ((_ago(1), 1.0, 10.0, None), False),
        ((_ago(1), 1.0, 10.000001, None), True),
        ((_ago(1), float("nan"), 11.0, None), False),
        ((_ago(1), 1.0, float("nan"), None), False),
        ((_ago(1), 1.0, None, None), False),
    ],
)
def test_boundaries(spark, row, kept):
    assert refine(spark.createDataFrame([row], CANONICAL), SETTINGS).count() == int(kept)


def test_as_of_defaults_to_the_current_date(spark):
    df = spark.createDataFrame([(5.0, 11.0)], "actual_volume double, rolling_4w_median double")
    today, tomorrow = F.current_date(), F.date_add(F.current_date(), 1)
    assert refine(df.withColumn("event_date", today)).count() == 1
    assert refine(df.withColumn("event_date", tomorrow)).count() == 0
    assert refine(df.withColumn("event_date", F.date_sub(today, 731))).count() == 0


def test_missing_actual_is_rejected_without_the_positive_filter(spark):
    df = spark.createDataFrame([(_ago(1), None, 11.0, None), (_ago(1), -1.0, 11.0, None)], CANONICAL)
    loose = Settings(as_of=TODAY, positive_actual_only=False)
    assert [row.actual_volume for row in refine(df, loose).collect()] == [-1.0]


def test_switches(spark):
    df = spark.createDataFrame([(_ago(-1), 0.0, 11.0, None)], CANONICAL)
    loose = Settings(as_of=TODAY, bound_above=False, positive_actual_only=False)
    assert refine(df, loose).count() == 1
    strict = Settings(
        as_of=TODAY, bound_above=False, positive_actual_only=False, require_target=True
    )
    assert refine(df, strict).count() == 0


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "daily.parquet")
    rows = [(_ago(1), 100.0, 20.0, 0.1)]
    spark.createDataFrame(rows, CANONICAL).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = refine(spark.read.parquet(path), SETTINGS)._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for pushed in (
        f"GreaterThanOrEqual(event_date,{_ago(730)})",
        f"LessThanOrEqual(event_date,{TODAY})",
        "GreaterThan(actual_volume,0.0)",
        "GreaterThan(rolling_4w_median,10.0)",
    ):
        assert pushed in plan


def test_drop_counts(spark):
    df = spark.createDataFrame(
        [
            (_ago(1), 5.0, 20.0, None),
            (None, 5.0, 20.0, None),
            (_ago(900), 0.0, 20.0, None),
            (_ago(1), float("nan"), 3.0, None),
        ],
        CANONICAL,
    )
    row = drop_counts(df, SETTINGS).first()
    assert (row.total_rows, row.kept_rows, row.dropped_rows) == (4, 1, 3)
    assert (row.missing_date, row.missing_actual, row.before_cutoff) == (1, 1, 1)
    assert (row.non_positive_actual, row.low_baseline, row.missing_baseline) == (1, 1, 0)


@pytest.mark.parametrize(
    ("valid", "expected", "passed", "reason", "zone"),
    [
        (1000, 1000, True, None, 1),
        (1100, 1000, True, None, 1),
        (981, 1000, True, None, 1),
        # 1 - 980 / 1000 is slightly above 0.02 in floating point
        (980, 1000, True, "WARNING: ApprovedSchemaDeviation", 2),
        (979, 1000, True, "WARNING: ApprovedSchemaDeviation", 2),
        (900, 1000, True, "WARNING: ApprovedSchemaDeviation", 2),
        (500, 1000, True, "WARNING: ApprovedSchemaDeviation", 2),
        (499, 1000, False, "CRITICAL: DataStarvationError", 3),
        (400, 1000, False, "CRITICAL: DataStarvationError", 3),
        (0, 0, False, "CRITICAL: DataQualityError", 3),
    ],
)
def test_guardrail_zones(spark, valid, expected, passed, reason, zone):
    counts = spark.createDataFrame([(valid, expected)], "valid_rows long, expected_row_count long")
    row = judge_volume(counts).first()
    assert (row.passed, row.failure_reason) == (passed, reason)
    assert row.workflow_impact_flag.startswith(f"ZONE_{zone}_")
    assert row.drop_frac == (1.0 - valid / expected if expected else 1.0)


def test_guardrail_action(spark, caplog):
    refined = spark.range(95)
    enforce_guardrail(guardrail(refined, Settings(expected_rows=96)))
    assert not caplog.records
    enforce_guardrail(guardrail(refined, Settings(expected_rows=100)))
    assert "ZONE_2" in caplog.text
    with pytest.raises(RuntimeError, match="DataStarvationError"):
        enforce_guardrail(guardrail(refined, Settings(expected_rows=1000)))
