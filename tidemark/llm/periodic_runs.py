"""Periodic runs of words, found tile by tile and stitched.

A run is a longest stretch of words in which words ``period`` apart are the same, twice the
period long at least. Periods fall into octaves, 2^k to 2^(k+1) - 1. A document explodes into
tiles, for each octave as wide as the octave needs: neighbours overlap by two of its longest
periods, so every stretch of two periods lies within a tile. A tile is solved by itself.
Boundaries stand half an octave's period apart, so that the equal words of a run fill the space
between two of them, and Z-functions on both sides of a boundary give the stretch around it for
all periods of the octave at once. The parts of a run that tiles found meet again by document
and period and are stitched.

A text of fewer words than the narrowest tile is one tile, and its parts are whole runs; it is
finished where it lies. Only longer texts travel, each once, however many rows have it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import pick, text_or_empty
from tidemark.staging import Stages

#: Below this octave every word is a boundary; above, words are compared by blocks.
BLOCKS_FROM = 4
RUN = "struct<start: long, length: long, period: long>"
#: Words of the tiles that a Python worker sends at once.
WORDS_AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Tiling:
    """``least_run`` words make a run; tiles have 2^``width`` words at least."""

    least_run: int = 12
    width: int = 14

    def __post_init__(self):
        if not 2 <= self.least_run <= 2 ** (self.width - 1):
            raise ValueError("A run must fit into half a tile, and have two words.")


def octaves_of(words: int) -> int:
    """How many octaves hold a period that fits twice."""
    return max(0, (words // 2).bit_length())


def tiles_of(words: int, tiling: Tiling) -> Iterator[tuple[int, int, int, int]]:
    """``start, stop, first octave, last octave``. Octaves that share a width share tiles."""
    shared = tiling.width - 3
    bands = [(0, shared), *[(octave, octave) for octave in range(shared + 1, octaves_of(words))]]
    if words < tiling.least_run:
        return
    for low, high in bands:
        width = 2 ** max(tiling.width, high + 3)
        if words <= width:
            # One tile serves this octave and all above.
            yield 0, words, low, octaves_of(words) - 1
            return
        for start in range(0, words - width // 2, width // 2):
            yield start, min(words, start + width), low, high


# Solving a tile


def z_function(text: list[int], count: int) -> list[int]:
    """Of the first ``count`` places, how many words from there repeat the beginning."""
    length = len(text)
    z = [0] * min(count, length)
    if z:
        z[0] = length
    left = right = 0
    for place in range(1, len(z)):
        reach = min(right - place, z[place - left]) if place < right else 0
        while place + reach < length and text[reach] == text[place + reach]:
            reach += 1
        if place + reach > right:
            left, right = place, place + reach
        z[place] = reach
    return z


def matches(pattern: list[int], z: list[int], text: list[int], count: int) -> list[int]:
    """Of the first ``count`` places of ``text``, how many words repeat ``pattern``'s first;
    ``z`` is the pattern's own Z-function over ``count`` places."""
    out = [0] * count
    left = right = 0
    for place in range(count):
        reach = min(right - place, z[place - left]) if left < place < right else 0
        while (
            reach < len(pattern)
            and place + reach < len(text)
            and pattern[reach] == text[place + reach]
        ):
            reach += 1
        if place + reach > right:
            left, right = place, place + reach
        out[place] = reach
    return out


def _smallest(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether no divisor of the period is a period as well."""
    left, prime = period, 2
    while left > 1:
        if left % prime:
            prime += 1 if prime * prime <= left else left - prime
            continue
        while left % prime == 0:
            left //= prime
        shorter = period // prime
        if np.array_equal(ids[start : start + period - shorter], ids[start + shorter : start + period]):
            return False
    return True


def _near(ids: np.ndarray, period: int, least: int) -> Iterator[tuple[int, int]]:
    """Stretches of a short period, from the lengths of equal words at every place."""
    needed = max(period, least - period)
    same = np.flatnonzero(ids[period:] == ids[:-period])
    if len(same) < needed:
        return
    breaks = np.flatnonzero(np.diff(same) != 1)
    first = same[np.concatenate([[0], breaks + 1])]
    last = same[np.concatenate([breaks, [len(same) - 1]])]
    long = last - first + 1 >= needed
    for start, stop in zip(first[long].tolist(), last[long].tolist()):
        yield start, stop + 1 + period


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64 and their inverses."""
    base = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        both = [
            np.cumprod(np.array([1] + [factor] * size, np.uint64), dtype=np.uint64)
            for factor in (base, pow(base, -1, 2**64))
        ]
    return both[0], both[1]


class _Blocks:
    """Hashes of the blocks of words that begin at each place."""

    def __init__(self, ids: np.ndarray):
        self.words = len(ids)
        self.powers, self.inverses = _powers(1 << len(ids).bit_length())
        with np.errstate(over="ignore"):
            mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(29)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self.powers[: len(ids)], dtype=np.uint64)])

    def of(self, length: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            sums = self.sums[length:] - self.sums[:-length]
            return sums * self.inverses[: len(sums)]

    def agree(self, places: np.ndarray, periods: np.ndarray, most: int) -> np.ndarray:
        """How many words around each place equal those a period later, as far as hashes tell:
        never fewer than there are, up to about ``most`` on either side."""
        ahead, behind = np.zeros_like(places), np.zeros_like(places)
        sums, factors = self.sums, self.powers[periods]
        step = 1 << most.bit_length()
        with np.errstate(over="ignore"):
            while step:
                start = places + ahead
                inside = start + step + periods <= self.words
                start = np.where(inside, start, 0)
                later = np.where(inside, start + periods, 0)
                same = (sums[start + step * inside] - sums[start]) * factors == sums[later + step * inside] - sums[later]
                ahead += step * (inside & same)
                start = places - behind - step
                inside = start >= 0
                start = np.where(inside, start, 0)
                later = np.where(inside, start + periods, 0)
                same = (sums[start + step * inside] - sums[start]) * factors == sums[later + step * inside] - sums[later]
                behind += step * (inside & same)
                step >>= 1
        return ahead + behind


def _far(ids: np.ndarray, octave: int, least: int, blocks: _Blocks) -> Iterator[tuple[int, int, int]]:
    """``period, start, stop`` of the octave's stretches, from boundaries 2^(octave - 1) apart.

    Words that agree over a whole period agree over a block between two boundaries; blocks are
    compared by hash to find the periods worth a Z-function, which alone decides."""
    size, words = 1 << (octave - 1), len(ids)
    if words < 4 * size:
        return
    hashes = blocks.of(size)
    width = 4 * size
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[: len(hashes) : size, 2 * size :]
    at, ahead = np.nonzero(rows == hashes[::size, None])
    boundaries, periods = at * size, ahead + 2 * size
    inside = boundaries + periods < len(hashes)
    boundaries, periods = boundaries[inside], periods[inside]
    long = blocks.agree(boundaries, periods, width) >= periods
    if not long.any():
        return
    boundaries, periods = boundaries[long].tolist(), periods[long].tolist()
    text = ids.tolist()
    back = text[::-1]
    seen: dict[int, int] = {}
    here, ahead_of, behind = -1, [], []
    for boundary, period in zip(boundaries, periods):
        if seen.get(period, -1) > boundary:
            continue
        if boundary != here:
            here = boundary
            ahead_of = z_function(text[boundary:], width)
            before = back[words - boundary :]
            # Reversed, what ends a period after the boundary begins width - period early.
            further = min(words, boundary + width)
            after = back[words - further :]
            reach = further - boundary
            behind = matches(before, z_function(before, reach), after, reach)
        start = boundary - behind[reach - period]
        stop = boundary + period + ahead_of[period]
        seen[period] = stop - period
        if stop - start >= max(2 * period, least):
            yield period, start, stop


def solve_tile(ids: np.ndarray, low: int, high: int, least: int) -> list[tuple[int, int, int]]:
    """``period, start, stop`` of the longest stretches within the tile whose smallest period is
    in the octaves from ``low`` to ``high``, of ``least`` words and two periods at least."""
    found = []
    for octave in range(low, min(high, BLOCKS_FROM - 1, octaves_of(len(ids)) - 1) + 1):
        for period in range(1 << octave, min(2 << octave, len(ids) // 2 + 1)):
            found += [(period, start, stop) for start, stop in _near(ids, period, least)]
    block = 1 << (BLOCKS_FROM - 1)
    if high >= BLOCKS_FROM and len(ids) >= 4 * block:
        blocks = _Blocks(ids)
        shortest = np.sort(blocks.of(block))
        # Without a block of words that occurs twice there is no longer period.
        if (shortest[1:] == shortest[:-1]).any():
            for octave in range(max(low, BLOCKS_FROM), min(high, octaves_of(len(ids)) - 1) + 1):
                found += _far(ids, octave, least, blocks)
    return sorted({one for one in found if _smallest(ids, one[1], one[0])})


def words_of(text: str) -> list[bytes]:
    """Runs of characters other than ASCII white space, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def _numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int32, len(words))


def collapse(words: list[bytes], runs: Iterable[tuple[int, int, int]]) -> str:
    """The words without those that any run (start, length, period) holds after its first
    period, joined by one space."""
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    if not kept.all():
        words = [words[place] for place in np.flatnonzero(kept)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def _runs(parts: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    return sorted((start, stop - start, period) for period, start, stop in parts)


# On Spark


def _run_column(rows: list[list[tuple[int, int, int]]]) -> pa.Array:
    names = ("start", "length", "period")
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in names]))
    return pa.array([[dict(zip(names, run)) for run in runs] for runs in rows], kind)


def _finishing(tiling: Tiling):
    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, left, counts = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                ids, parts = _numbered(words), []
                for start, stop, low, high in tiles_of(len(words), tiling):
                    parts += solve_tile(ids[start:stop], low, high, tiling.least_run)
                every.append(_runs(parts))
                counts.append(len(words))
                left.append(collapse(words, every[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), _run_column(every), pa.array(left, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return finish


def _tiling(tiling: Tiling):
    names = ["key", "start", "low", "high", "ids"]

    def tile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key"), batch.column("text")):
                ids = _numbered(words_of(text.as_py()))
                rows, size = [], 0

                def packed():
                    key_, start, low, high, own = zip(*rows)
                    ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own)))
                    columns = [pa.array(key_, pa.binary()), pa.array(start, pa.int64()),
                               pa.array(low, pa.int32()), pa.array(high, pa.int32()), lists]
                    return pa.RecordBatch.from_arrays(columns, names)

                for start, stop, low, high in tiles_of(len(ids), tiling):
                    rows.append((key.as_py(), start, low, high, ids[start:stop]))
                    size += stop - start
                    if size >= WORDS_AT_ONCE:
                        yield packed()
                        rows, size = [], 0
                if rows:
                    yield packed()

    return tile


def _solving(least: int):
    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch.column(name) for name in ("key", "start", "low", "high", "ids")]
            for key, offset, low, high, ids in zip(*columns):
                own = ids.values.to_numpy(zero_copy_only=False)
                shift = offset.as_py()
                for period, start, stop in solve_tile(own, low.as_py(), high.as_py(), least):
                    rows.append((key.as_py(), period, shift + start, shift + stop))
            if rows:
                key_, *numbers = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key_, pa.binary()), *[pa.array(values, pa.int64()) for values in numbers]],
                    ["key", "period", "start", "stop"],
                )

    return solve


def _collapsing():
    def collapse_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, counts = [], []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                words = words_of(text.as_py())
                own = [(run["start"], run["length"], run["period"]) for run in runs.as_py() or []]
                counts.append(len(words))
                left.append(collapse(words, own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(counts, pa.int64()), batch.column("runs"), pa.array(left, pa.string())],
                ["key", "n_words", "runs", "collapsed"],
            )

    return collapse_all


def stitch(parts: DataFrame, least: int) -> DataFrame:
    """``key, period, start, stop`` of whole runs from parts of the same columns.

    Parts of one run overlap by two periods, those of two runs by less than one. Equal parts,
    which neighbouring tiles or equal texts report, combine before they are shuffled."""
    sets = parts.groupBy("key", "period").agg(F.collect_set(F.struct("start", "stop")).alias("parts"))
    rows = sets.select("key", "period", F.explode("parts").alias("part")).select("key", "period", "part.*")
    place = Window.partitionBy("key", "period").orderBy("start", "stop")
    before = F.max("stop").over(place.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") > before - F.col("period"), F.lit(True)).cast("int")
    return (
        rows.withColumn("begins", begins)
        .withColumn("run", F.sum("begins").over(place))
        .groupBy("key", "period", "run")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .filter(F.col("stop") - F.col("start") >= F.greatest(F.lit(least), 2 * F.col("period")))
        .select("key", "period", "start", "stop")
    )


def _runs_of_long_texts(texts: DataFrame, tiling: Tiling) -> DataFrame:
    """``key, runs`` of the texts (``key, text``) that have a run. Their tiles are dealt to all
    tasks, so that a very long text is solved by many."""
    tiles = texts.mapInArrow(_tiling(tiling), "key binary, start long, low int, high int, ids array<int>")
    dealt = tiles.repartition("key", "low", "start")
    parts = dealt.mapInArrow(_solving(tiling.least_run), "key binary, period long, start long, stop long")
    run = F.struct("start", (F.col("stop") - F.col("start")).alias("length"), "period")
    whole = stitch(parts, tiling.least_run).select("key", run.alias("run"))
    return whole.groupBy("key").agg(F.array_sort(F.collect_list("run")).alias("runs"))


def periodic_runs(
    docs: DataFrame,
    tiling: Tiling = Tiling(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, runs, collapsed``.

    Words are runs of characters other than ASCII white space, numbered from 0. ``runs`` is an
    array of (start, length, period), by start and then period: every stretch of words with
    that smallest period, ``least_run`` words and two periods long at least, which no word
    beside it extends. ``collapsed`` has the words, joined by one space, that no run holds
    after its first period.

    A null text counts as empty; a text without words has no runs and an empty ``collapsed``.
    The result depends on the text alone, so that null and repeated identifiers and repeated
    rows are no special case. A very long text is solved tile by tile in many tasks; one task
    holds its words, never its tiles. An empty table gives an empty result. Further columns
    are ignored, whatever they are called.
    """
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    # A word and what separates it have two bytes at least.
    short: Column = F.octet_length("text") <= 2 << tiling.width
    kind = dict(rows.dtypes)["doc_id"]
    finished = rows.filter(short).mapInArrow(
        _finishing(tiling), f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string"
    )
    key = F.unhex(F.sha2("text", 256)).alias("key")
    long = rows.filter(~short).select("doc_id", key, "text")
    spark = docs.sparkSession
    with Stages(spark) as stages:
        texts = stages(
            long.groupBy("key").agg(F.any_value("text").alias("text")), "long-texts"
        )
        found = _runs_of_long_texts(texts, tiling)
        solved = stages.keep(
            texts.join(found, "key", "left")
            .select("key", "text", F.coalesce("runs", F.array().cast(f"array<{RUN}>")).alias("runs"))
            .mapInArrow(_collapsing(), f"key binary, n_words long, runs array<{RUN}>, collapsed string"),
            "long-runs",
        )
    travelled = long.select("doc_id", "key").join(solved, "key").drop("key")
    return finished.unionByName(travelled)
