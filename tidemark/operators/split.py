"""Time split into contiguous train, validation and test windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.config import CLIENT, DATE, MONTH, Settings
from tidemark.errors import TooLittleHistory
from tidemark.functions.expressions import month_number, with_row

PARTS = ("train", "val", "test")


def split_bounds(df: DataFrame, settings: Settings = Settings(), date: str = DATE) -> DataFrame:
    """One row: the last date and the first dates of the validation and test windows."""
    bounds = df.agg(F.max(date).alias("max_date"))
    bounds = bounds.withColumn("test_start", F.date_sub("max_date", settings.test_days - 1))
    return bounds.withColumn("val_start", F.date_sub("test_start", settings.val_days))


def label_split(
    df: DataFrame,
    settings: Settings = Settings(),
    date: str = DATE,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Add ``split``; the bounds enter the plan as a scalar subquery, nothing is joined."""
    bounds = split_bounds(df, settings, date) if bounds is None else bounds
    day = F.col(date)
    labelled = with_row(df, bounds, "_bounds").withColumn(
        "split",
        F.when(day < F.col("_bounds.val_start"), "train")
        .when(day < F.col("_bounds.test_start"), "val")
        .when(day >= F.col("_bounds.test_start"), "test"),
    )
    return labelled.drop("_bounds")


def part_rows(df: DataFrame, bounds: DataFrame, *parts: str, date: str = DATE) -> DataFrame:
    """Rows of adjacent parts by plain date ranges, which reach the scan; labels do not. Of
    rows that lie in folders by month, the folders outside the range are not read."""
    starts = {"val": bounds.select("val_start").scalar(), "test": bounds.select("test_start").scalar()}
    wanted = [PARTS.index(part) for part in parts]
    if sorted(wanted) != list(range(min(wanted), max(wanted) + 1)):
        raise ValueError(f"Parts are not adjacent: {parts}")
    first, after = min(wanted), max(wanted) + 1
    rows = df.filter(F.col(date).isNotNull())
    by_month = MONTH in df.columns
    if first:
        rows = rows.filter(F.col(date) >= starts[PARTS[first]])
        if by_month:
            rows = rows.filter(F.col(MONTH) >= month_number(starts[PARTS[first]]))
    if after < len(PARTS):
        rows = rows.filter(F.col(date) < starts[PARTS[after]])
        if by_month:
            rows = rows.filter(F.col(MONTH) <= month_number(starts[PARTS[after]]))
    return rows


def split_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("split").agg(F.count(F.lit(1)).alias("row_count"))


def require_all_parts(labelled: DataFrame) -> dict[str, int]:
    """Fail unless train, val and test all hold rows; returns the counts."""
    counted = {row.split: row.row_count for row in split_counts(labelled).collect()}
    if not set(counted) - {None}:
        raise TooLittleHistory("The date column holds no valid value.", "no dates")
    sizes = {part: counted.get(part, 0) for part in PARTS}
    if min(sizes.values()) == 0:
        shown = ", ".join(f"{part}={sizes[part]}" for part in PARTS)
        raise TooLittleHistory(f"Too little history to split by time: {sizes}", shown, sum(sizes.values()))
    return sizes


def in_date_order(df: DataFrame, date: str = DATE) -> DataFrame:
    """Global date order, for presentation only: no operator depends on it.

    The client breaks ties, so that a day with very many rows is sorted by several tasks.
    """
    return df.orderBy(date, CLIENT)
