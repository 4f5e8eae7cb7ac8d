"""Client restrictions: champion list and minimum median volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.config import ACTUAL, CLIENT, Settings
from tidemark.staging import stage


def champion_rows(df: DataFrame, champions: DataFrame) -> DataFrame:
    """Rows of the listed clients.

    The list is reduced to distinct names first, so repeated names cost nothing; Spark
    broadcasts it when its measured size allows.
    """
    return _rows_of(df, champions.select(CLIENT).distinct())


def client_medians(df: DataFrame) -> DataFrame:
    """Approximate median volume per client; only fixed-size sketches are shuffled."""
    return df.groupBy(CLIENT).agg(
        F.percentile_approx(ACTUAL, F.lit(0.5)).alias("median_daily_volume")
    )


def active_clients(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Clients whose median lies strictly above the minimum."""
    return client_medians(df).filter(
        F.col("median_daily_volume") > F.lit(settings.min_client_median)
    )


def _rows_of(df: DataFrame, clients: DataFrame) -> DataFrame:
    """Rows of the listed clients. The list is a stage table, so both sides of the join are
    plain exchanges and adaptive execution can split a client that holds much of the rows."""
    return df.join(stage(clients.select(CLIENT), "clients"), CLIENT, "left_semi")


def active_rows(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows of the active clients. ``df`` is read twice: pass a stage table or a scan."""
    return _rows_of(df, active_clients(df, settings))


def restrict_clients(
    df: DataFrame, champions: DataFrame | None = None, settings: Settings = Settings()
) -> DataFrame:
    """Rows of the clients that are active and, if a list is given, on it.

    The lists are reduced to one before the rows are filtered once.
    """
    clients = active_clients(df, settings)
    if champions is not None:
        clients = clients.join(champions.select(CLIENT), CLIENT, "left_semi")
    return _rows_of(df, clients)
