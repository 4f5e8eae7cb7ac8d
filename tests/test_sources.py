from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.sources import event_columns, find_column, load, project_canonical, require_rows, source_kind
from tidemark.staging import stage, stage_root

CSV = """\ufeffevent_date,actual_volume,rolling_4w_median,is_china,is_domestic
2024-11-30,42.5,37,1,1
2024-12-24,8,9.25,0,0
soon,1300,950,0,1
"""


@pytest.mark.parametrize(
    ("source", "kind"),
    [
        ("catalog.schema.daily", "table"),
        ("daily.csv", "csv"),
        ("catalog.schema.daily.csv", "csv"),
        ("data/daily", "folder"),
        ("data\\v1.2\\daily", "folder"),
        ("daily", "folder"),
        ("daily.parquet", "parquet"),
        ("/data/daily.parquet/", "parquet"),
    ],
)
def test_source_kind(source, kind):
    assert source_kind(source) == kind


def test_aliases_ignore_case_and_keep_their_order():
    assert find_column(["PREADVICE_DATE", "date_date"], "event_date") == "PREADVICE_DATE"
    assert find_column(["DATE_DATE", "Event_Date"], "event_date") == "Event_Date"
    assert find_column(["Target", "TARGET"], "target") == "TARGET"
    assert find_column(["volume"], "actual_volume") is None


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "daily.csv"
    path.write_text(CSV, encoding="utf-8")
    rows = project_canonical(load(spark, str(path))).collect()
    assert [row.event_date for row in rows] == [date(2024, 11, 30), date(2024, 12, 24), None]
    assert rows[0].actual_volume == 42.5
    assert rows[0].client_name is None
    assert (rows[2].is_china, rows[2].is_domestic) == (0, 1)


def test_a_folder_is_opened_by_what_it_holds(spark, tmp_path):
    rows = spark.range(3).withColumnRenamed("id", "n")
    rows.write.parquet(str(tmp_path / "plain"))
    rows.write.option("header", True).csv(str(tmp_path / "text"))
    assert load(spark, str(tmp_path / "plain")).dtypes == [("n", "bigint")]
    assert load(spark, str(tmp_path / "text")).dtypes == [("n", "string")]
    assert load(spark, str(tmp_path / "plain"), format="parquet").count() == 3
    with pytest.raises(ValueError, match="orc"):
        load(spark, "anything", format="orc")


def test_csv_with_declared_schema(spark, tmp_path):
    path = tmp_path / "daily.csv"
    path.write_text("event_date,actual_volume\n2026-01-01,1.5\n")
    rows = load(spark, str(path), "event_date date, actual_volume double").collect()
    assert rows == [(date(2026, 1, 1), 1.5)]


def test_missing_columns_are_named(spark):
    df = spark.range(1).select(F.current_date().alias("DATE_DATE"))
    with pytest.raises(ValueError, match="actual_volume.*rolling_4w_median.*DATE_DATE"):
        project_canonical(df)
    full = df.select("*", F.lit(1).alias("parcel_volume"), F.lit(1).alias("median_4wk_volume"))
    assert project_canonical(full).columns == [
        "client_name", "event_date", "actual_volume", "rolling_4w_median", "is_china", "is_domestic",
    ]
    with pytest.raises(ValueError, match="target"):
        project_canonical(full, Settings(require_target=True))
    with pytest.raises(ValueError, match="is_china"):
        project_canonical(full, Settings(default_missing_flags=False))


def test_columns_differing_only_in_case_resolve_to_the_last(spark):
    df = spark.createDataFrame(
        [(date(2026, 1, 1), 1.0, 2.0, 50.0, 1, 2)],
        ["event_date", "actual_volume", "ACTUAL_VOLUME", "rolling_4w_median", "event_x", "EVENT_X"],
    )
    row = project_canonical(df).first()
    assert row.actual_volume == 2.0
    assert row.event_x == 2


def test_date_and_number_coercion(spark):
    texts = [
        ("2026-01-02", "12.5", date(2026, 1, 2), 12.5),
        (" 2026-01-02T10:30:00 ", " 7 ", date(2026, 1, 2), 7.0),
        ("20260102", "1e3", date(2026, 1, 2), 1000.0),
        ("1/2/2026", "-.5", date(2026, 1, 2), -0.5),
        ("2026-13-40", "12d", None, None),
        ("2026-01-02 xx", "nan", None, None),
        ("", "", None, None),
        (None, None, None, None),
        ("soon", "1,000", None, None),
        ("2026", "-Inf", date(2026, 1, 1), float("-inf")),
        ("2026-01-02", "0x1p3", date(2026, 1, 2), None),
        ("2026-01-02", "3F", date(2026, 1, 2), None),
    ]
    df = spark.createDataFrame(
        [(i, d, v, "20") for i, (d, v, _, _) in enumerate(texts)],
        "client_name int, event_date string, actual_volume string, rolling_4w_median string",
    )
    rows = sorted(project_canonical(df).collect(), key=lambda row: int(row.client_name))
    assert [(row.event_date, row.actual_volume) for row in rows] == [t[2:] for t in texts]


def test_typed_dates_and_nan(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 1, 2, 23, 59), float("nan"), 20.0)],
        "DATE_DATE timestamp, parcel_volume double, median_4wk_volume double",
    )
    row = project_canonical(df).first()
    assert row.event_date == date(2026, 1, 2)
    assert row.actual_volume is None


def test_event_flags(spark):
    df = spark.createDataFrame(
        [(date(2026, 1, 1), 1.0, 20.0, "200.7", float("nan"), "x", True, None, ["a"])],
        "event_date date, actual_volume double, rolling_4w_median double, event_wide string,"
        " EVENT_Gap double, event_text string, event_bool boolean, event_none int,"
        " events array<string>",
    )
    assert event_columns(df.schema) == {
        "event_wide": "event_wide", "event_gap": "EVENT_Gap", "event_text": "event_text",
        "event_bool": "event_bool", "event_none": "event_none",
    }
    row = project_canonical(df).first()
    assert (row.event_wide, row.event_gap, row.event_text, row.event_bool, row.event_none) == (
        200, 0, 0, 1, 0,
    )


def test_require_rows(spark):
    with pytest.raises(ValueError, match="nothing"):
        require_rows(spark.range(0), "nothing here")
    assert require_rows(spark.range(1), "").count() == 1


def test_stage_uses_the_session_folder(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    staged = stage(df, "numbers")
    assert all(stage_root(spark) in name for name in staged.inputFiles())
    assert sorted(staged.collect()) == sorted(df.collect())
