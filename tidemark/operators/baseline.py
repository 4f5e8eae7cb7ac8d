"""Rolling baseline: median of a client's preceding days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.config import ACTUAL, BASELINE, CLIENT, DATE, Settings


def rolling_baseline(client_days: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add the median of the preceding days, current day excluded, NULL without history.

    The input holds one row per client and day, so a frame holds at most
    ``baseline_window_days`` values and a client's window group at most one row per
    calendar day, however many raw rows a client has.
    """
    frame = (
        Window.partitionBy(CLIENT)
        .orderBy(F.unix_date(DATE))
        .rangeBetween(-settings.baseline_window_days, -1)
    )
    return client_days.withColumn(BASELINE, F.percentile(ACTUAL, F.lit(0.5)).over(frame))
