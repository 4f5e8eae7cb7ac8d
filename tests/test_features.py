import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.functions.expressions import deviation_signal
from tidemark.operators import validate
from tidemark.operators.baseline import rolling_baseline
from tidemark.operators.features import (
    add_calendar_parts,
    add_cyclical_features,
    add_uplift_target,
    feature_columns,
    restore_volume,
)
from tidemark.operators.split import in_date_order, label_split, require_all_parts, split_bounds

VOLUMES = "actual_volume double, rolling_4w_median double"


def _days(spark, count, start=date(2026, 1, 1)):
    rows = [("a", start + timedelta(days=i), float(i)) for i in range(count)]
    return spark.createDataFrame(rows, "client_name string, event_date date, actual_volume double")


def test_cyclical_features_of_a_year(spark):
    rows = add_cyclical_features(_days(spark, 365)).collect()
    waves = [name for name in rows[0].asDict() if name.endswith(("_sin", "_cos"))]
    assert len(waves) == 10
    assert all(-1.0 <= row[name] <= 1.0 for row in rows for name in waves)


def test_january_and_monday(spark):
    january = add_cyclical_features(_days(spark, 1)).first()
    assert january.month_sin == pytest.approx(math.sin(2 * math.pi / 12))
    monday = add_cyclical_features(_days(spark, 1, date(2031, 3, 3))).first()
    assert (monday.dow_sin, monday.dow_cos) == (0.0, 1.0)


def test_leap_day_and_long_iso_year(spark):
    row = add_calendar_parts(_days(spark, 1, date(2020, 12, 31))).first()
    assert (row.day_of_year, row.week_of_year, row.day_of_week) == (366, 53, 3)


def test_input_columns_are_kept_and_repeatable(spark):
    df = _days(spark, 3)
    assert add_cyclical_features(df).columns[:3] == df.columns
    assert add_cyclical_features(df).collect() == add_cyclical_features(df).collect()


def test_uplift_roundtrip_and_floor(spark):
    df = spark.createDataFrame(
        [(100.0, 100.0), (120.0, 100.0), (80.0, 100.0), (0.0, 100.0)], VOLUMES
    )
    rows = restore_volume(add_uplift_target(df), "target", "restored").collect()
    assert [row.restored for row in rows[:3]] == pytest.approx([100.0, 120.0, 80.0])
    assert rows[3].target == math.log(1e-6)


def test_target_replaces_an_incoming_one(spark):
    df = spark.createDataFrame([(100.0, 100.0, 9.0)], VOLUMES + ", target double")
    assert add_uplift_target(df).first().target == 0.0


@pytest.mark.parametrize(
    ("row", "failing"),
    [
        ((None, 1.0), "missing_actual"),
        ((1.0, None), "missing_baseline"),
        ((1.0, 0.0), "non_positive_baseline"),
        ((-1.0, 1.0), "negative_actual"),
        ((-1.0, 0.0), "non_positive_baseline"),
    ],
)
def test_target_checks(spark, row, failing):
    df = spark.createDataFrame([row, (1.0, 1.0)], VOLUMES)
    with pytest.raises(ValueError, match=f"{failing} failed for 1 rows"):
        validate.validate_target_input(df)
    validate.validate_target_input(spark.createDataFrame([(0.0, 1.0)], VOLUMES))
    with pytest.raises(ValueError, match="rolling_4w_median"):
        validate.validate_target_input(df.drop("rolling_4w_median"))


def test_inverse_checks(spark):
    schema = "uplift double, rolling_4w_median double"
    for bad, failing in ((0.0, "non_positive"), (None, "missing")):
        with pytest.raises(ValueError, match=f"{failing}_baseline"):
            validate.validate_inverse_input(
                spark.createDataFrame([(0.0, 100.0), (0.1, bad)], schema)
            )
    validate.validate_inverse_input(spark.createDataFrame([(0.0, 100.0)], schema))


@pytest.mark.parametrize(
    ("row", "failing"),
    [
        (("2026-01-01", -1.0, 100.0), "negative_actual"),
        (("2026-01-01", 1.0, 0.0), "non_positive_baseline"),
        ((None, -1.0, 0.0), "missing_required_value"),
    ],
)
def test_input_checks(spark, row, failing):
    schema = "event_date string, " + VOLUMES
    df = spark.createDataFrame([("2026-01-01", 100.0, 100.0), row], schema)
    with pytest.raises(ValueError, match=failing):
        validate.validate_input(df)
    with pytest.raises(ValueError, match="actual_volume"):
        validate.validate_input(df.drop("actual_volume"))
    validate.validate_input(df.limit(1))


def test_feature_choice():
    columns = ["month_sin", "dow_cos", "is_china", "event_x", "event_date", "actual_volume"]
    assert feature_columns(columns) == ["dow_cos", "event_x", "is_china", "month_sin"]
    assert feature_columns(["x", "y"], ["y", "x"]) == ["y", "x"]
    with pytest.raises(ValueError, match="z"):
        feature_columns(["x"], ["x", "z"])
    with pytest.raises(ValueError, match="No feature"):
        feature_columns(["event_date", "actual_volume"])


def test_rolling_baseline_excludes_today_and_older_days(spark):
    start = date(2026, 1, 1)
    rows = [("a", start, 10.0), ("a", start + timedelta(days=1), 20.0),
            ("a", start + timedelta(days=28), 30.0), ("a", start + timedelta(days=29), 40.0),
            ("a", start + timedelta(days=58), 50.0), ("b", start, 1.0)]
    df = spark.createDataFrame(rows, "client_name string, event_date date, actual_volume double")
    got = {
        (row.client_name, (row.event_date - start).days): row.rolling_4w_median
        for row in rolling_baseline(df).collect()
    }
    assert got == {("a", 0): None, ("a", 1): 10.0, ("a", 28): 15.0, ("a", 29): 25.0,
                   ("a", 58): None, ("b", 0): None}


def test_split_of_a_hundred_days(spark):
    settings = Settings(test_days=14, val_days=14)
    labelled = label_split(_days(spark, 100), settings)
    assert require_all_parts(labelled) == {"train": 72, "val": 14, "test": 14}
    bounds = split_bounds(_days(spark, 100), settings).first()
    assert bounds.max_date == date(2026, 4, 10)
    assert bounds.test_start == date(2026, 3, 28)
    assert bounds.val_start == date(2026, 3, 14)
    by_date = {row.event_date: row.split for row in labelled.collect()}
    assert by_date[date(2026, 3, 13)] == "train"
    assert by_date[date(2026, 3, 14)] == by_date[date(2026, 3, 27)] == "val"
    assert by_date[date(2026, 3, 28)] == "test"


def test_split_needs_history(spark):
    settings = Settings(test_days=14, val_days=14)
    with pytest.raises(ValueError, match="Too little history.*'train': 0"):
        require_all_parts(label_split(_days(spark, 20), settings))
    dateless = _days(spark, 2).withColumn("event_date", F.lit(None).cast("date"))
    with pytest.raises(ValueError, match="no valid value"):
        require_all_parts(label_split(dateless, settings))


def test_date_order(spark):
    dates = [row.event_date for row in in_date_order(_days(spark, 50).repartition(4)).collect()]
    assert dates == sorted(dates)


def test_signal_of_missing_or_zero_baseline(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (15.0, 10.0)], VOLUMES)
    signal = deviation_signal(F.col("actual_volume"), F.col("rolling_4w_median"))
    assert [row[0] for row in df.select(signal).collect()] == [0.0, 0.0, 0.5]
