from datetime import date

from tidemark.config import Settings
from tidemark.operators.clients import active_rows, champion_rows, client_medians, restrict_clients

DAY = date(2026, 1, 1)


def _rows(spark):
    volumes = {"big": [5.0, 20.0, 30.0], "edge": [10.0, 10.0], "small": [1.0, 2.0], None: [99.0]}
    return spark.createDataFrame(
        [(client, DAY, volume) for client, group in volumes.items() for volume in group],
        "client_name string, event_date date, actual_volume double",
    )


def test_champions_keep_rows_once_and_never_match_null(spark):
    champions = spark.createDataFrame(
        [("big", 1), ("big", 2), (None, 3), ("absent", 4)], "client_name string, rank int"
    )
    kept = champion_rows(_rows(spark), champions).collect()
    assert [row.client_name for row in kept] == ["big"] * 3


def test_median_must_exceed_the_minimum(spark):
    medians = {row.client_name: row.median_daily_volume for row in client_medians(_rows(spark)).collect()}
    assert medians["big"] == 20.0
    assert {row.client_name for row in active_rows(_rows(spark)).collect()} == {"big"}
    low = Settings(min_client_median=9.9)
    assert {row.client_name for row in active_rows(_rows(spark), low).collect()} == {"big", "edge"}


def test_both_restrictions(spark):
    champions = spark.createDataFrame([("edge",), ("small",)], "client_name string")
    low = Settings(min_client_median=5.0)
    kept = restrict_clients(_rows(spark), champions, low).collect()
    assert {row.client_name for row in kept} == {"edge"}
    assert restrict_clients(_rows(spark), None, low).count() == 5
