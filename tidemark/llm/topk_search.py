"""Exact top-k search by inner product, a block of documents at a time.

Vectors of whole numbers are cut, in the order of their identifiers, into blocks of neighbours.
A block has a forward index, its vectors as they are, and the largest and smallest value of
every term. The sum over the terms of what they allow at most bounds all scores in a block. For
each query the blocks are ordered by that bound and scored from the highest on, until the bound
falls below the k-th best score so far. A first such score comes from the block that the query
itself lies in, so that pruning starts at once.

Blocks form shards and queries form batches, both of bounded size. A shard meets each batch once,
and only the best k of a query leave it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import pick
from tidemark.staging import Stages

#: Whole numbers up to here are exact as doubles.
EXACT = 2.0**53
#: Stands for a null identifier among equal scores: it comes last.
LAST = np.iinfo(np.int64).max

BLOCK = "shard long, first long, ids binary, known binary, vectors binary, kind string, width int, highs binary, lows binary"
QUERY = "batch long, place long, query_id long, least double, vector binary, kind string, width int"
HIT = "place long, query_id long, vec_id long, known boolean, score long"


@dataclass(frozen=True)
class Index:
    """Vectors in a block, vectors in a shard, shards whose queries form a batch."""

    block: int = 64
    shard: int = 1024
    batch: int = 16


def whole_numbers(vector: Column, scale: int) -> Column:
    """``floor(scale * component)`` as longs; null where a component is null or not finite."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    usable = F.forall(
        numbers,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.when(usable, F.transform(numbers, lambda x: F.floor(F.lit(scale) * x).cast("long")))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows as whole numbers; as doubles where those are exact anyway."""
    if left.size and right.size:
        most = float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1]
        if most < EXACT:
            return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def upper_bounds(queries: np.ndarray, highs: np.ndarray, lows: np.ndarray) -> np.ndarray:
    """For each query and block the sum of what each term can contribute at most."""
    return products(np.maximum(queries, 0), highs) + products(np.minimum(queries, 0), lows)


def _padded(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for place, row in enumerate(rows):
        out[place, : len(row)] = row
    return out


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """As the smallest kind of whole number that holds them."""
    most = max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)) - 1)
    return numbers.astype(next(kind for kind in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(kind).max))


def _blocks(index: Index):
    """The blocks of a shard from its rows ``shard, place, vec_id, vector``."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        vectors = [vector.values.to_numpy(zero_copy_only=False) for vector in rows["vector"].combine_chunks()]
        ids = rows["vec_id"].to_pylist()
        places = rows["place"].to_pylist()
        out = []
        for start in range(0, len(vectors), index.block):
            own, named = vectors[start : start + index.block], ids[start : start + index.block]
            matrix = _padded(own, max(1, *map(len, own)))
            packed = _narrow(matrix)
            out.append(
                (rows["shard"][0].as_py(), places[start],
                 np.array([LAST if one is None else one for one in named], np.int64).tobytes(),
                 np.array([one is not None for one in named]).tobytes(),
                 packed.tobytes(), packed.dtype.str, matrix.shape[1],
                 matrix.max(0).tobytes(), matrix.min(0).tobytes())
            )
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.string(), pa.int32(), *[pa.binary()] * 2]
        return pa.table([pa.array(values, kind) for values, kind in zip(zip(*out), kinds)], _names(BLOCK))

    return build


class _Block:
    def __init__(self, row: dict):
        self.first, self.width = row["first"], row["width"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(len(self.ids), self.width).astype(np.int64)
        self.highs = np.frombuffer(row["highs"], np.int64)
        self.lows = np.frombuffer(row["lows"], np.int64)


def _queries(k: int, every: int, index: Index):
    """The queries of each block, with the k-th best score that their own block gives."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                block = _Block(row)
                chosen = np.flatnonzero(block.known & (block.ids % every == 0))
                scores = products(block.vectors[chosen], block.vectors)
                for own, at in zip(scores, chosen.tolist()):
                    others = np.sort(np.delete(own, at))
                    least = float(others[-k]) if len(others) >= k else float("-inf")
                    packed = _narrow(block.vectors[at])
                    rows.append(
                        (row["shard"] // index.batch, block.first + at, int(block.ids[at]), least,
                         packed.tobytes(), packed.dtype.str, block.width)
                    )
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.binary(), pa.string(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], _names(QUERY)
                )

    return find


class Search:
    """The best k of a shard for each query of a batch."""

    def __init__(self, queries: list[dict], blocks: list[_Block], k: int):
        self.k, self.blocks, self.rows = k, blocks, queries
        width = max([row["width"] for row in queries] + [block.width for block in blocks])
        own = [np.frombuffer(row["vector"], row["kind"]) for row in queries]
        self.vectors = _padded(own, width)
        for block in blocks:
            if block.width < width:
                block.vectors = _padded(list(block.vectors), width)
        highs = _padded([block.highs for block in blocks], width)
        lows = _padded([block.lows for block in blocks], width)
        bounds = upper_bounds(self.vectors, highs, lows)
        self.order = np.argsort(-bounds, axis=1, kind="stable")
        self.bounds = np.take_along_axis(bounds, self.order, axis=1)
        self.least = np.array([row["least"] for row in queries])
        #: Scores, identifiers and whether those are known, of each query's best so far.
        self.best: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = [None] * len(queries)

    def _score(self, number: int, asking: np.ndarray, found: dict[int, list]) -> None:
        block = self.blocks[number]
        scores = products(self.vectors[asking], block.vectors)
        good = scores >= self.least[asking][:, None]
        for row in np.flatnonzero(good.any(axis=1)).tolist():
            query, keep = int(asking[row]), good[row]
            itself = self.rows[query]["place"] - block.first
            if 0 <= itself < len(keep):
                keep[itself] = False
            found.setdefault(query, []).append((scores[row][keep], block.ids[keep], block.known[keep]))

    def _settle(self, query: int, parts: list) -> None:
        if self.best[query] is not None:
            parts = [self.best[query], *parts]
        scores, ids, known = (np.concatenate(values) for values in zip(*parts))
        kept = np.lexsort((ids, -scores))[: self.k]
        self.best[query] = scores[kept], ids[kept], known[kept]
        if len(kept) == self.k:
            self.least[query] = max(self.least[query], float(scores[kept[-1]]))

    def run(self) -> None:
        """Rounds of 1, 1, 2, 4, ... further blocks for each query that its bounds leave."""
        done, step = 0, 1
        while done < len(self.blocks):
            upto = min(len(self.blocks), done + step)
            # Of equal scores the smaller identifier wins: a block that can tie is scored.
            queries, places = np.nonzero(self.bounds[:, done:upto] >= self.least[:, None])
            if not len(queries):
                break
            numbers = self.order[queries, places + done]
            by_block = np.argsort(numbers, kind="stable")
            numbers, queries = numbers[by_block], queries[by_block]
            starts = np.flatnonzero(np.diff(numbers, prepend=-1))
            found: dict[int, list] = {}
            for start, stop in zip(starts, [*starts[1:], len(numbers)]):
                self._score(int(numbers[start]), queries[start:stop], found)
            for query, parts in found.items():
                self._settle(query, parts)
            done, step = upto, done or 1

    def hits(self) -> Iterator[tuple]:
        for row, best in zip(self.rows, self.best):
            if best is not None:
                for score, vec_id, known in zip(*(values.tolist() for values in best)):
                    yield row["place"], row["query_id"], vec_id, known, score


def _searching(k: int):
    def search(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        hits: list[tuple] = []
        if queries.num_rows and blocks.num_rows:
            found = Search(queries.to_pylist(), [_Block(row) for row in blocks.to_pylist()], k)
            found.run()
            hits = list(found.hits())
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        columns = zip(*hits) if hits else [()] * len(kinds)
        return pa.table([pa.array(values, kind) for values, kind in zip(columns, kinds)], _names(HIT))

    return search


def top_k(
    vectors: DataFrame,
    k: int = 20,
    *,
    scale: int = 64,
    query_every: int = 20,
    index: Index = Index(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose identifier ``query_every`` divides,
    the ``k`` other rows of the highest inner product, ranks from 1.

    Components become ``floor(scale * component)``, and scores are whole numbers. Equal scores
    rank by identifier, the smaller first, a null one last. With fewer rows than that all are
    returned. Vectors that are null or hold null or non-finite components take no part; of
    vectors of different lengths the shorter one counts as ending in zeros. A null identifier
    makes no query. Every row of a repeated identifier is a query and a candidate of its own.
    An empty table gives an empty result; further columns are ignored, whatever they are called.
    """
    spark = vectors.sparkSession
    rows = pick(vectors, id_column, vector_column).toDF("vec_id", "vector")
    usable = rows.select(
        F.col("vec_id").cast("long"), whole_numbers(F.col("vector"), scale).alias("vector")
    ).filter(F.col("vector").isNotNull())
    # Ranges of identifiers; rows alike in them are told apart by their vectors' hash.
    ranged = (
        usable.withColumn("other", F.xxhash64("vector"))
        .repartitionByRange("vec_id", "other")
        .sortWithinPartitions("vec_id", "other")
        .select("vec_id", "vector", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at"))
    )
    with Stages(spark) as stages:
        placed = stages(ranged, "topk-ranges")
        counts = placed.groupBy("range").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
        before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        starts = counts.select(
            "range", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
        )
        ranked = placed.join(starts, "range").select(
            (F.col("start") + F.col("at") - F.col("first")).alias("place"), "vec_id", "vector"
        )
        sharded = ranked.withColumn("shard", F.floor(F.col("place") / index.shard))
        blocks = stages(sharded.groupBy("shard").applyInArrow(_blocks(index), BLOCK), "topk-blocks")
        queries = stages(blocks.mapInArrow(_queries(k, query_every, index), QUERY), "topk-queries")

        def all_of(df: DataFrame, name: str) -> Column:
            return F.explode(df.select(name).distinct().agg(F.collect_list(name)).scalar()).alias(name)

        # A batch asks every shard and a shard answers every batch: a stated set against all
        # rows, in pieces of bounded size.
        asking = queries.select("*", all_of(blocks, "shard")).groupBy("batch", "shard")
        asked = blocks.select("*", all_of(queries, "batch")).groupBy("batch", "shard")
        hits = asking.cogroup(asked).applyInArrow(_searching(k), HIT)
        best = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
        return stages.keep(
            hits.withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("known"), F.col("vec_id")).alias("vec_id"), "score"),
            "topk-hits",
        )
