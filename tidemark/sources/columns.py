"""Column resolution on names and types only; nothing here reads data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.config import (
    ACTUAL,
    ALIASES,
    BASELINE,
    CLIENT,
    DATE,
    EVENT_PREFIX,
    FLAGS,
    TARGET,
    Settings,
)
from tidemark.errors import MissingColumns
from tidemark.functions.expressions import safe_date, safe_double, safe_int

# Names with the event prefix that are not event flags.
EVENTS_EXCLUDED = (DATE, "events")
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def find_column(columns: list[str], wanted: str) -> str | None:
    """The column accepted for ``wanted``: first alias wins, letter case is ignored.

    Of columns that differ only in case the last one counts.
    """
    by_lower_name = {name.lower(): name for name in columns}
    accepted = (wanted, *ALIASES.get(wanted, ()))
    hits = [by_lower_name[name.lower()] for name in accepted if name.lower() in by_lower_name]
    return hits[0] if hits else None


def event_columns(schema: T.StructType) -> dict[str, str]:
    """Event flag columns as {lower-cased name: source name}, nested types left out."""
    return {
        field.name.lower(): field.name
        for field in schema.fields
        if field.name.lower().startswith(EVENT_PREFIX)
        and field.name.lower() not in EVENTS_EXCLUDED
        and not isinstance(field.dataType, _NESTED)
    }


def _one_column_per_name(df: DataFrame) -> DataFrame:
    """Keep the last of any columns whose names differ only in case."""
    last = {name.lower(): position for position, name in enumerate(df.columns)}
    if len(last) == len(df.columns):
        return df
    positions = sorted(last.values())
    renamed = df.toDF(*[f"c{position}" for position in range(len(df.columns))])
    return renamed.select(
        *[F.col(f"c{position}").alias(df.columns[position]) for position in positions]
    )


@dataclass(frozen=True)
class Canonical:
    """The canonical columns of a source, as expressions over its own columns."""

    df: DataFrame
    columns: dict[str, Column]
    floating: dict[str, Column]

    def select(self, rows: DataFrame | None = None) -> DataFrame:
        return (self.df if rows is None else rows).select(
            *[column.alias(name) for name, column in self.columns.items()]
        )

    def exceeds(self, name: str, limit: float) -> Column:
        """``name > limit``; compares the source column itself so that scans can prune."""
        if name in self.floating:
            raw = self.floating[name]
            return (raw > F.lit(limit)) & ~F.isnan(raw)
        return self.columns[name] > F.lit(limit)


def canonical_columns(df: DataFrame, settings: Settings) -> Canonical:
    """Resolve names, fail on missing required ones, and coerce every kept column."""
    df = _one_column_per_name(df)
    found = {name: find_column(df.columns, name) for name in (CLIENT, *ALIASES)}
    required = [DATE, ACTUAL, BASELINE]
    if settings.require_target:
        required.append(TARGET)
    if not settings.default_missing_flags:
        required.extend(FLAGS)
    missing = [name for name in required if found[name] is None]
    if missing:
        message = f"Required columns {missing} not found; the source has {df.columns}."
        raise MissingColumns(message, ", ".join(missing))

    types = {name: df.schema[source].dataType for name, source in found.items() if source}
    columns: dict[str, Column] = {}
    if found[CLIENT]:
        columns[CLIENT] = F.col(found[CLIENT]).cast("string")
    else:
        columns[CLIENT] = F.lit(None).cast("string")
    columns[DATE] = safe_date(F.col(found[DATE]), types[DATE], settings.date_formats)
    for name in (ACTUAL, BASELINE, TARGET):
        if found[name]:
            columns[name] = safe_double(F.col(found[name]), types[name])
    for name in FLAGS:
        columns[name] = safe_int(F.col(found[name]), types[name]) if found[name] else F.lit(0)
    for name, source in event_columns(df.schema).items():
        flag = safe_int(F.col(source), df.schema[source].dataType)
        columns[name] = F.coalesce(flag, F.lit(0))
    floating = {
        name: F.col(source)
        for name, source in found.items()
        if source and isinstance(types[name], T.FractionalType) and name in (ACTUAL, BASELINE)
        and not isinstance(types[name], T.DecimalType)
    }
    return Canonical(df, columns, floating)


def project_canonical(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rename and coerce to the canonical schema without dropping any row."""
    return canonical_columns(df, settings).select()
