"""Calendar features, the log-uplift target and the choice of model features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.config import ACTUAL, BASELINE, CYCLES, DATE, EVENT_PREFIX, FLAGS, TARGET, Settings
from tidemark.functions.expressions import fail_on, log_uplift, undo_log_uplift
from tidemark.operators.validate import inverse_checks


def add_calendar_parts(df: DataFrame, date: str = DATE) -> DataFrame:
    day = F.col(date)
    return df.withColumns(
        {
            "month": F.month(day),
            "day_of_week": F.weekday(day),  # Monday is 0
            "day_of_year": F.dayofyear(day),
            "week_of_year": F.weekofyear(day),
            "day_of_month": F.dayofmonth(day),
        }
    )


def add_cyclical_features(df: DataFrame, date: str = DATE) -> DataFrame:
    """Calendar parts plus the sine and cosine of each on its period."""
    waves = {}
    for prefix, part, period in CYCLES:
        angle = F.lit(2.0) * F.pi() * F.col(part) / F.lit(period)
        waves[f"{prefix}_sin"] = F.sin(angle)
        waves[f"{prefix}_cos"] = F.cos(angle)
    return add_calendar_parts(df, date).withColumns(waves)


def fill_flags(df: DataFrame) -> DataFrame:
    """Treat a missing business flag as not set."""
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in FLAGS})


def add_uplift_target(
    df: DataFrame,
    settings: Settings = Settings(),
    actual: str = ACTUAL,
    baseline: str = BASELINE,
) -> DataFrame:
    """Log of actual over baseline, floored; replaces any target that came with the data."""
    return df.withColumn(
        TARGET, log_uplift(F.col(actual), F.col(baseline), settings.clip_floor)
    )


def restore_volume(
    df: DataFrame, uplift: str, volume: str, baseline: str = BASELINE, *, guarded: bool = False
) -> DataFrame:
    """Turn a predicted log uplift back into a volume.

    ``guarded``, the plan itself fails at the first row whose baseline fails an inverse check,
    where it is used and on streams as well."""
    usable = F.col(baseline)
    if guarded:
        usable = fail_on(usable, inverse_checks(baseline))
    return df.withColumn(volume, undo_log_uplift(F.col(uplift), usable))


def feature_columns(
    columns: Sequence[str], explicit: Sequence[str] = (), date: str = DATE
) -> list[str]:
    """The model's feature names: an explicit list as given, otherwise inferred and sorted."""
    if explicit:
        missing = [name for name in explicit if name not in columns]
        if missing:
            raise ValueError(f"Configured features not in the data: {missing}")
        return list(explicit)
    inferred = sorted(
        name
        for name in columns
        if name != date
        and (name.endswith(("_sin", "_cos")) or name.startswith(EVENT_PREFIX) or name in FLAGS)
    )
    if not inferred:
        raise ValueError("No feature columns: neither cyclical features nor flags are present.")
    return inferred
