"""Scalar column expressions; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SMAPE_EPSILON = 1e-9


# Texts the JVM reads as doubles but that are no number in a table: "nan", "0x1p3", "12d".
_NO_NUMBER = r"(?i)nan|0x|[\d.][df]$"


def safe_double(column: Column, dtype: T.DataType) -> Column:
    """Number or NULL: unparsable text and NaN both become NULL."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        number = column.cast("double")
        return F.when(~F.isnan(number), number)
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return column.cast("double")
    text = F.trim(column.cast("string"))
    return F.when(~text.rlike(_NO_NUMBER), text.try_cast("double"))


def safe_int(column: Column, dtype: T.DataType) -> Column:
    """Whole number or NULL, truncating fractions."""
    if isinstance(dtype, T.IntegerType):
        return column
    return safe_double(column, dtype).try_cast("int")


def safe_date(column: Column, dtype: T.DataType, formats: tuple[str, ...] = ()) -> Column:
    """Calendar date or NULL; typed dates and timestamps pass through untouched."""
    if isinstance(dtype, T.DateType):
        return column
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return column.cast("date")
    text = F.trim(column.cast("string"))
    parsed = [text.try_cast("timestamp_ntz").cast("date")]
    # A failed pattern costs an exception: only texts that start like a date are tried.
    dated = text.rlike(r"^\d")
    parsed += [F.when(dated, F.try_to_timestamp(text, F.lit(f)).cast("date")) for f in formats]
    return F.coalesce(*parsed)


def month_number(day: Column) -> Column:
    """2001-11-04 is in month 200111."""
    return F.year(day) * 100 + F.month(day)


def smape_term(actual: Column, predicted: Column) -> Column:
    """One row's share of SMAPE; ``avg`` of it times 100 is the metric."""
    scale = F.abs(actual) + F.abs(predicted) + F.lit(SMAPE_EPSILON)
    return F.lit(2.0) * F.abs(predicted - actual) / scale


def smape(actual: Column, predicted: Column) -> Column:
    return F.avg(smape_term(actual, predicted)) * F.lit(100.0)


def log_uplift(actual: Column, baseline: Column, floor: float) -> Column:
    return F.ln(F.greatest(actual / baseline, F.lit(floor)))


def undo_log_uplift(uplift: Column, baseline: Column) -> Column:
    return F.exp(uplift) * baseline


def fail_on(value: Column, checks: dict[str, Column]) -> Column:
    """The value; where a check holds, the query fails with the first such check's name."""
    guarded = value
    for name, bad in reversed(checks.items()):
        message = F.lit(f"Check {name} failed.")
        guarded = F.when(bad, F.raise_error(message).cast("double")).otherwise(guarded)
    return guarded


def deviation_signal(actual: Column, baseline: Column) -> Column:
    """Relative distance from the baseline; 0 where the baseline is 0 or missing."""
    return F.coalesce(F.abs(actual - baseline) / F.nullif(baseline, F.lit(0.0)), F.lit(0.0))


def hours_between(start: Column, end: Column, dtype: T.DataType) -> Column:
    """Elapsed hours, unaffected by daylight-saving shifts of the session time zone."""
    if isinstance(dtype, T.TimestampNTZType):
        seconds = (end - start).cast("interval second").cast("decimal(20,6)").cast("double")
    else:
        seconds = F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)
    return seconds / F.lit(3600.0)


def with_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Attach a one-row frame as a struct column through one scalar subquery, not a join."""
    return df.withColumn(name, row.select(F.struct(*row.columns).alias("row")).scalar())
