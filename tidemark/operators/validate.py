"""Input checks: every check is a count, all counts of one check list share one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.config import ACTUAL, BASELINE, DATE
from tidemark.errors import CheckFailed, MissingColumns


def _require_columns(df: DataFrame, names: list[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise MissingColumns(f"Missing required columns: {missing}", ", ".join(missing))


def input_checks(date: str = DATE, actual: str = ACTUAL, baseline: str = BASELINE) -> dict[str, Column]:
    absent = F.col(date).isNull() | F.col(actual).isNull() | F.col(baseline).isNull()
    return {
        "missing_required_value": absent,
        "negative_actual": F.col(actual) < 0,
        "non_positive_baseline": F.col(baseline) <= 0,
    }


def target_checks(actual: str = ACTUAL, baseline: str = BASELINE) -> dict[str, Column]:
    return {
        "missing_actual": F.col(actual).isNull(),
        "missing_baseline": F.col(baseline).isNull(),
        "non_positive_baseline": F.col(baseline) <= 0,
        "negative_actual": F.col(actual) < 0,
    }


def inverse_checks(baseline: str = BASELINE) -> dict[str, Column]:
    return {
        "missing_baseline": F.col(baseline).isNull(),
        "non_positive_baseline": F.col(baseline) <= 0,
    }


def violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row with the number of violating rows per check."""
    return df.agg(*[F.count_if(bad).alias(name) for name, bad in checks.items()])


def run_checks() -> dict[str, Column]:
    """All checks of a training run by group and name, in the order in which they count."""
    groups = {"input": input_checks(), "target": target_checks(), "inverse": inverse_checks()}
    return {f"{group}_{name}": bad for group, checks in groups.items() for name, bad in checks.items()}


def raise_first(counts: Mapping[str, int], checks: Mapping[str, Column], prefix: str = "") -> None:
    """Raise for the first of the checks, in their order, that counted rows."""
    for name in checks:
        if counts[prefix + name]:
            rows = counts[prefix + name]
            raise CheckFailed(f"Check {name} failed for {rows} rows.", name, rows)


def enforce_counts(counts: Mapping[str, int]) -> None:
    """What the three ``validate_`` functions do, from counts of ``run_checks`` taken before."""
    raise_first(counts, input_checks(), "input_")
    raise_first(counts, target_checks(), "target_")
    raise_first(counts, inverse_checks(), "inverse_")


def _raise_first(df: DataFrame, checks: dict[str, Column]) -> None:
    raise_first(violations(df, checks).first().asDict(), checks)


def validate_input(
    df: DataFrame, date: str = DATE, actual: str = ACTUAL, baseline: str = BASELINE
) -> None:
    """Raise on the first failing training-input check."""
    _require_columns(df, [date, actual, baseline])
    _raise_first(df, input_checks(date, actual, baseline))


def validate_target_input(df: DataFrame, actual: str = ACTUAL, baseline: str = BASELINE) -> None:
    """Raise on the first failing check of the log-uplift input."""
    _require_columns(df, sorted({actual, baseline}))
    _raise_first(df, target_checks(actual, baseline))


def validate_inverse_input(df: DataFrame, baseline: str = BASELINE) -> None:
    """Raise on the first failing check of the inverse transform's baseline."""
    _require_columns(df, [baseline])
    _raise_first(df, inverse_checks(baseline))
