"""Byte-level BPE encoding and decoding over the ranks of a public vocabulary.

Pre-tokens that are whole vocabulary entries are resolved by a minimal perfect hash; the
others by merging their bytes, kept in a linked list, in the order of a heap of pair ranks.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator, Mapping
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import pick

#: Characters whose pre-tokens a task holds at once.
CHARACTERS_AT_ONCE = 1 << 20
#: Pre-tokens that a Python worker remembers before it starts anew.
REMEMBERED = 600_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a base64 token and a rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PerfectHash:
    """Minimal perfect hash of the tokens: n keys take the slots 0 to n - 1.

    Keys fall into n buckets; from the largest bucket on, each gets the first displacement
    that puts all its keys into free slots. A bucket of one key names its slot directly (as
    a number above all displacements). A lookup computes the one slot where a key can be and
    compares the token there with it.
    """

    DIRECT = np.uint64(1 << 32)

    def __init__(self, ranks: Mapping[bytes, int]):
        tokens = list(ranks)
        self.size = np.uint64(max(1, len(tokens)))
        self.buckets = self.size
        hashes = self.hashes(tokens)
        if len(np.unique(hashes)) < len(tokens):
            raise ValueError("Two tokens have the same 64-bit hash.")
        bucket = hashes % self.buckets
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(int(self.buckets) + 1))
        self.displacement = np.zeros(int(self.buckets), np.uint64)
        taken = np.zeros(int(self.size), bool)
        sizes = np.diff(starts)
        for number in np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes > 1)]:
            own = hashes[order[starts[number] : starts[number + 1]]]
            displacement = 0
            while True:
                slots = self._slots(own, np.uint64(displacement))
                if not taken[slots].any() and len(np.unique(slots)) == len(slots):
                    break
                displacement += 1
            taken[slots] = True
            self.displacement[number] = displacement
        single = np.flatnonzero(sizes == 1)
        self.displacement[single] = self.DIRECT + np.flatnonzero(~taken)[: len(single)].astype(np.uint64)
        self.tokens: list[bytes] = [b""] * len(tokens)
        self.ranks = np.zeros(int(self.size), np.int64)
        for token, slot in zip(tokens, self.slots(hashes).tolist()):
            self.tokens[slot] = token
            self.ranks[slot] = ranks[token]

    @classmethod
    def restore(cls, state: dict) -> PerfectHash:
        """From ``vars`` of another, which executors can read without this package."""
        perfect = cls.__new__(cls)
        vars(perfect).update(state)
        return perfect

    @staticmethod
    def hashes(keys: Iterable[bytes]) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        return np.fromiter(map(xxh3_64_intdigest, keys), np.uint64)

    def _slots(self, hashes: np.ndarray, displacement) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = (hashes ^ (displacement * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(
                0xD6E8FEB86659FD93
            )
        return ((mixed ^ (mixed >> np.uint64(32))) % self.size).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        displacement = self.displacement[(hashes % self.buckets).astype(np.int64)]
        direct = displacement >= self.DIRECT
        return np.where(
            direct,
            (displacement - np.where(direct, self.DIRECT, np.uint64(0))).astype(np.int64),
            self._slots(hashes, displacement),
        )

    def find(self, keys: list[bytes]) -> list[int]:
        """Ranks of the keys, -1 for those that are no tokens."""
        if not self.tokens:
            return [-1] * len(keys)
        slots = self.slots(self.hashes(keys))
        tokens = self.tokens
        return [
            rank if tokens[slot] == key else -1
            for key, slot, rank in zip(keys, slots.tolist(), self.ranks[slots].tolist())
        ]


def merge_bytes(piece: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """Ranks of a pre-token that is no token: the pair of least rank merges first, of equal
    pairs the leftmost. Raises KeyError where the vocabulary lacks a byte."""
    n = len(piece)
    # A heap entry is one number: rank, start and stop of the pair from its high bits down.
    bits = n.bit_length()
    low = (1 << bits) - 1
    rank_of = ranks.get
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = []
    for start in range(n - 1):
        rank = rank_of(piece[start : start + 2])
        if rank is not None:
            heap.append((rank << bits | start) << bits | start + 2)
    heapify(heap)
    while heap:
        entry = heappop(heap)
        stop = entry & low
        start = entry >> bits & low
        middle = end[start]
        # Outdated: a part of the pair has merged with another since.
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[start] = stop
        end[middle] = 0
        if stop < n:
            before[stop] = start
            after = end[stop]
            rank = rank_of(piece[start:after])
            if rank is not None:
                heappush(heap, (rank << bits | start) << bits | after)
        left = before[start]
        if left >= 0:
            rank = rank_of(piece[left:stop])
            if rank is not None:
                heappush(heap, (rank << bits | left) << bits | stop)
    out, start = [], 0
    while start < n:
        stop = end[start]
        out.append(ranks[piece[start:stop]])
        start = stop
    return out


class Encoder:
    """Encodes texts; remembers the pre-tokens that it has seen, up to a bound."""

    def __init__(self, pattern: str, perfect: PerfectHash):
        import regex

        self.pieces = regex.compile(pattern).findall
        self.perfect = perfect
        self.ranks = dict(zip(perfect.tokens, perfect.ranks.tolist()))
        #: Ids of a pre-token as 32-bit numbers in a row.
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: list[list[str]]) -> None:
        fresh = list(set(chain.from_iterable(pieces)).difference(self.known))
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
            fresh = list(set(chain.from_iterable(pieces)))
        keys = [piece.encode() for piece in fresh]
        for piece, key, rank in zip(fresh, keys, self.perfect.find(keys)):
            ids = (rank,) if rank >= 0 else merge_bytes(key, self.ranks)
            self.known[piece] = array("i", ids).tobytes()

    def encode(self, texts: list[str]) -> pa.ListArray:
        pieces = [self.pieces(text) for text in texts]
        self._learn(pieces)
        known = self.known
        ids = [b"".join(map(known.__getitem__, own)) for own in pieces]
        offsets = np.cumsum([0, *map(len, ids)]) // 4
        values = np.frombuffer(b"".join(ids), np.int32)
        return pa.LargeListArray.from_arrays(offsets, values).cast(pa.list_(pa.int32()))


def _parts(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of bounded total length, with the position of the first."""
    first, held, size = 0, [], 0
    for place, text in enumerate(texts):
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= CHARACTERS_AT_ONCE:
            yield first, held
            first, held, size = place + 1, [], 0
    if held:
        yield first, held


def _encoding(pattern: str, shared):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pattern, PerfectHash.restore(shared.value))
        for batch in batches:
            for first, texts in _parts(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)), encoder.encode(texts)],
                    ["doc_id", "ids"],
                )

    return encode


def encode_texts(
    docs: DataFrame,
    ranks: Mapping[bytes, int],
    pattern: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, ids`` (array of int), without special tokens.

    Every match of ``pattern`` in the whole text is encoded by itself. A null text counts as
    empty and has no ids. Identifiers pass through as they are, null or repeated. An empty
    table gives an empty result. The vocabulary, of fixed size, goes to every worker.
    """
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(vars(PerfectHash(ranks)))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.withColumn("text", F.col("text").cast("string")).mapInArrow(
        _encoding(pattern, shared), f"doc_id {kind}, ids array<int>"
    )


def _decoding(shared, names: list[str]):
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                values = ids.values
                own = values.to_numpy().tolist() if values is not None else []
                texts.append(b"".join(map(tokens.__getitem__, own)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], names
            )

    return decode


def decode_ids(encoded: DataFrame, ranks: Mapping[bytes, int]) -> DataFrame:
    """Adds ``decoded`` (binary), the bytes that ``ids`` stand for. Null ids are none; an id
    that the vocabulary lacks fails the job."""
    shared = encoded.sparkSession.sparkContext.broadcast({r: token for token, r in ranks.items()})
    schema = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(
        _decoding(shared, [*encoded.columns, "decoded"]), f"{schema}, decoded binary"
    )
