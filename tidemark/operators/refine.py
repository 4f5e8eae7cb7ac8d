"""Refinement: one projection and one filter, plus counts of what it drops."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidemark.config import ACTUAL, BASELINE, DATE, MONTH, TARGET, Settings
from tidemark.functions.expressions import month_number
from tidemark.operators.validate import run_checks
from tidemark.sources.columns import Canonical, canonical_columns


def as_of_date(settings: Settings) -> Column:
    return F.current_date() if settings.as_of is None else F.lit(settings.as_of)


def cutoff_date(settings: Settings) -> Column:
    """First day kept by the lookback."""
    return F.date_sub(as_of_date(settings), settings.lookback_days)


def _conditions(source: Canonical, settings: Settings) -> dict[str, Column]:
    """The keep conditions by the name under which their failures are counted."""
    date, actual = source.columns[DATE], source.columns[ACTUAL]
    conditions = {
        "missing_date": date.isNotNull(),
        "missing_actual": actual.isNotNull(),
        "missing_baseline": source.columns[BASELINE].isNotNull(),
        "before_cutoff": date >= cutoff_date(settings),
    }
    if settings.bound_above:
        conditions["after_as_of"] = date <= as_of_date(settings)
    if settings.positive_actual_only:
        conditions["non_positive_actual"] = source.exceeds(ACTUAL, 0.0)
    conditions["low_baseline"] = source.exceeds(BASELINE, settings.min_baseline)
    if settings.require_target:
        conditions["missing_target"] = source.columns[TARGET].isNotNull()
    return conditions


def _kept(source: Canonical, settings: Settings, rows: DataFrame) -> DataFrame:
    conditions = _conditions(source, settings)
    # A comparison already rejects NULL; a second look would parse text sources again.
    implied = {"missing_date", "missing_baseline"}
    if settings.positive_actual_only:
        implied.add("missing_actual")
    for name, condition in conditions.items():
        if name not in implied:
            rows = rows.filter(condition)
    return source.select(rows)


def _in_lookback_months(df: DataFrame, settings: Settings) -> DataFrame:
    """Of a history that is partitioned by month, the folders that the lookback touches."""
    if MONTH not in df.columns:
        return df
    rows = df.filter(F.col(MONTH) >= month_number(cutoff_date(settings)))
    if settings.bound_above:
        rows = rows.filter(F.col(MONTH) <= month_number(as_of_date(settings)))
    return rows


def refine(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Canonical client-day rows inside the lookback that can be trained on."""
    source = canonical_columns(_in_lookback_months(df, settings), settings)
    return _kept(source, settings, source.df)


def observed_refine(
    df: DataFrame, settings: Settings = Settings()
) -> tuple[DataFrame, Observation, Observation]:
    """``refine``, with the counts of ``drop_counts`` and the check counts of the kept rows.

    Both observations fill when the rows are first written, in that one pass over the source;
    the second has ``valid_rows`` and a count for each of ``run_checks``. Counting what is
    dropped takes every row, so no filter reaches the scan here."""
    source = canonical_columns(df, settings)
    seen, checked = Observation(), Observation()
    rows = source.df.observe(seen, *_drop_counts(source, settings))
    counts = [F.count_if(bad).alias(name) for name, bad in run_checks().items()]
    kept = _kept(source, settings, rows)
    return kept.observe(checked, F.count(F.lit(1)).alias("valid_rows"), *counts), seen, checked


def drop_counts(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row: how many rows each condition rejects, and how many survive all of them.

    A row can fail several conditions; one whose value is missing counts under the
    ``missing_*`` name only.
    """
    source = canonical_columns(df, settings)
    return source.df.agg(*_drop_counts(source, settings))


def _drop_counts(source: Canonical, settings: Settings) -> list[Column]:
    conditions = _conditions(replace(source, floating={}), settings)
    keep = F.lit(True)
    for condition in conditions.values():
        keep = keep & condition
    kept = F.count_if(F.coalesce(keep, F.lit(False)))
    return [
        F.count(F.lit(1)).alias("total_rows"),
        kept.alias("kept_rows"),
        (F.count(F.lit(1)) - kept).alias("dropped_rows"),
        *[F.count_if(~condition).alias(name) for name, condition in conditions.items()],
    ]
