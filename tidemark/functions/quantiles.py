"""Exact, linearly interpolated quantiles whose state stays bounded at any row count.

Spark's ``percentile`` is exact but merges a map of every distinct value in one final
task. Here each wanted rank is bracketed between two values taken from a fixed-size
quantile sketch, exact counts then decide on which side of (or on which of) the two values
the rank lies, and the bracket shrinks by the sketch accuracy on every round until the rank
falls on a value. Each round is two distributed aggregates that return one row of fixed
width, and heavily repeated values only help: they resolve through the equality counts.
The same rounds run at every size; small inputs need one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

ACCURACY = 10_000


@dataclass
class _Rank:
    """A wanted rank and the open interval of values that still contains it."""

    column: str
    rank: int
    inside: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def candidates(self) -> Column:
        kept = F.col(self.column).isNotNull()
        if self.low is not None:
            kept = kept & (F.col(self.column) > F.lit(self.low))
        if self.high is not None:
            kept = kept & (F.col(self.column) < F.lit(self.high))
        return kept

    @property
    def interval(self) -> tuple[str, float | None, float | None]:
        return self.column, self.low, self.high

    def probes(self, accuracy: int) -> list[float]:
        """Probabilities of two sketch quantiles expected to enclose the rank."""
        centre = (self.rank + 0.5) / self.inside
        margin = 2.0 / accuracy
        return [max(0.0, centre - margin), min(1.0, centre + margin)]

    def counts(self, left: float, right: float) -> Column:
        value, kept = F.col(self.column), self.candidates()
        return F.struct(
            F.count_if(kept & (value < left)).alias("below_left"),
            F.count_if(value == left).alias("at_left"),
            F.count_if(kept & (value < right)).alias("below_right"),
            F.count_if(value == right).alias("at_right"),
        )

    def narrow(self, left: float, right: float, seen: Row) -> None:
        upto_left = seen.below_left + seen.at_left
        upto_right = seen.below_right + seen.at_right
        if self.rank < seen.below_left:
            self.high, self.inside = left, seen.below_left
        elif self.rank < upto_left:
            self.value = left
        elif self.rank < seen.below_right:
            self.low, self.high = left, right
            self.rank -= upto_left
            self.inside = seen.below_right - upto_left
        elif self.rank < upto_right:
            self.value = right
        else:
            self.low = right
            self.rank -= upto_right
            self.inside -= upto_right


def _resolve(values: DataFrame, ranks: list[_Rank], accuracy: int) -> None:
    while open_ranks := [rank for rank in ranks if rank.value is None]:
        # Ranks of one column and interval share a sketch.
        sketches: dict[tuple, list[_Rank]] = {}
        for rank in open_ranks:
            sketches.setdefault(rank.interval, []).append(rank)
        rows = values.agg(
            *[
                F.percentile_approx(
                    F.when(group[0].candidates(), F.col(group[0].column)),
                    [p for rank in group for p in rank.probes(accuracy)],
                    accuracy,
                ).alias(f"s{i}")
                for i, group in enumerate(sketches.values())
            ]
        ).first()
        found = {
            id(rank): row[2 * place : 2 * place + 2]
            for row, group in zip(rows, sketches.values())
            for place, rank in enumerate(group)
        }
        probes = [found[id(rank)] for rank in open_ranks]
        counts = values.agg(
            *[rank.counts(*probes[i]).alias(f"r{i}") for i, rank in enumerate(open_ranks)]
        ).first()
        for i, rank in enumerate(open_ranks):
            rank.narrow(*probes[i], counts[i])


def _bracketed(
    values: DataFrame, wanted: dict[str, tuple[str, float]], accuracy: int
) -> dict[str, float | None]:
    measured = sorted({column for column, _ in wanted.values()})
    totals = values.agg(*[F.count(column).alias(column) for column in measured]).first()
    pairs = {}
    for name, (column, probability) in wanted.items():
        total = totals[column]
        if total == 0:
            continue
        position = probability * (total - 1)
        pairs[name] = (
            position,
            _Rank(column, math.floor(position), total),
            _Rank(column, math.ceil(position), total),
        )
    _resolve(values, [rank for _, *both in pairs.values() for rank in both], accuracy)

    found: dict[str, float | None] = dict.fromkeys(wanted)
    for name, (position, lower, upper) in pairs.items():
        if lower.value == upper.value:
            found[name] = lower.value
        else:
            share = position - math.floor(position)
            found[name] = (1.0 - share) * lower.value + share * upper.value
    return found


def exact_quantiles(
    df: DataFrame,
    measures: dict[str, Column],
    wanted: dict[str, tuple[str, float]],
    *,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row with a column per entry of ``wanted`` (output name -> measure, probability).

    ``df`` is read several times, so pass a stage table or another cheap, stable input.
    """
    values = df.select(*[column.cast("double").alias(name) for name, column in measures.items()])
    found = _bracketed(values, wanted, accuracy)
    return df.sparkSession.range(1).select(
        *[F.lit(value).cast("double").alias(name) for name, value in found.items()]
    )
