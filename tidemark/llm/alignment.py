"""Two tokenizers' cuts of the same bytes, aligned.

The places where tokens of A and tokens of B end are two sorted lists. Merging them visits every
overlap of an A and a B token once, and a place where both end closes a group. The merge is
divided by diagonals: the ends that come first in the merge, ``work`` for each piece, split into
so many of A and so many of B, which a binary search along the diagonal finds without merging.
Pieces are of equal work and independent; the groups at their edges are stitched by document.

How many documents link a pair of ids is counted once over the corpus. Documents keep their
distinct pairs packed by chunk of documents and bucket of A ids; a bucket's slices meet the
counts of its pairs, and only sums by document travel on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import pick, text_or_empty
from tidemark.staging import Stages

#: Ends that one piece merges.
WORK = 1 << 16
#: Characters of the texts encoded at once, and links whose pairs are packed together.
CHARACTERS_AT_ONCE = 1 << 20
LINKS_AT_ONCE = 1 << 20
#: Pairs that a counting task holds before it sends them on.
PAIRS_AT_ONCE = 1 << 22
#: Buckets of A ids, and links of the chunks that meet a bucket's counts in one task.
BUCKETS = 16
LINKS_PER_GROUP = 1 << 27
#: Bits of a B id in the number of a pair, and of the whole number.
B_BITS, PAIR_BITS = 15, 31

DIGESTS = "copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
SLICE = "bucket int, pairs binary, times binary"
PIECE = "key binary, copies long, piece int, a binary, b binary, a_start long, b_start long, own_a int, own_b int"
SOLVED = "key binary, copies long, piece int, n_a long, n_b long, closed long, n_links long, groups array<string>, pairs binary"


def diagonal(a: np.ndarray, b: np.ndarray, place: int) -> int:
    """How many of the first ``place`` ends in the merge are A's; of equal ends A's is first."""
    low, high = max(0, place - len(b)), min(place, len(a))
    while low < high:
        middle = (low + high) // 2
        if a[middle] <= b[place - 1 - middle]:
            low = middle + 1
        else:
            high = middle
    return low


def pieces_of(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, work: int) -> Iterator[tuple]:
    """``a, b, a_start, b_start, own_a, own_b``: a piece's ids, the next one of either side
    included, the bytes where they start, and how many are its own."""
    total, i, j = len(a) + len(b), 0, 0
    for place in range(work, total + work, work):
        upto_a = diagonal(ends_a, ends_b, min(place, total))
        upto_b = min(place, total) - upto_a
        yield (
            a[i : upto_a + 1], b[j : upto_b + 1],
            int(ends_a[i - 1]) if i else 0, int(ends_b[j - 1]) if j else 0,
            upto_a - i, upto_b - j,
        )
        i, j = upto_a, upto_b


class Solver:
    """Merges pieces; knows how many bytes every id stands for."""

    def __init__(self, lengths_a: np.ndarray, lengths_b: np.ndarray):
        self.lengths_a, self.lengths_b = lengths_a, lengths_b
        self.offset = len(lengths_a)
        numbers = [*map(str, range(len(lengths_a))), *map(str, range(len(lengths_b)))]
        split = len(lengths_a)
        # An id with what follows it within a group, or at the end of its side.
        self.written = [
            *[f"{number}," for number in numbers],
            *[f"{number}|" for number in numbers[:split]],
            *[f"{number};" for number in numbers[split:]],
        ]
        self.size = len(numbers)

    def solve(self, a: np.ndarray, b: np.ndarray, a_start: int, b_start: int, own_a: int, own_b: int) -> tuple:
        """Numbers of the linked pairs, one for each overlap; how many groups close; and the
        group (from 0, by closings) of every own token of A and of B."""
        ends_a = a_start + np.cumsum(self.lengths_a[a])
        ends_b = b_start + np.cumsum(self.lengths_b[b])
        own_ends_a, own_ends_b = ends_a[:own_a], ends_b[:own_b]
        over_b = np.searchsorted(ends_b, own_ends_a, "left")
        over_a = np.searchsorted(ends_a, own_ends_b, "left")
        closes = own_ends_b == a_start
        inside = over_a < own_a
        closes[inside] |= own_ends_a[over_a[inside]] == own_ends_b[inside]
        open_ = ~closes
        pairs = np.concatenate(
            [
                a[:own_a].astype(np.int64) << B_BITS | b[over_b],
                a[over_a[open_]].astype(np.int64) << B_BITS | b[:own_b][open_],
            ]
        )
        closings = own_ends_b[closes]
        return (
            pairs, len(closings),
            np.searchsorted(closings, own_ends_a, "left"), np.searchsorted(closings, own_ends_b, "left"),
        )

    def groups(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> str:
        """The groups as text; every group has tokens of both sides."""
        if not len(a):
            return ""
        last_a = np.append(group_a[1:] != group_a[:-1], True)
        last_b = np.append(group_b[1:] != group_b[:-1], True)
        index = np.concatenate([a + last_a * self.size, self.offset + b + last_b * self.size])
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        return "".join(map(self.written.__getitem__, index[order].tolist()))[:-1]

    def parts(self, a, b, own_a, own_b, closed, group_a, group_b) -> list[str]:
        """``first A, first B, middle, last A, last B``: the first group may have begun in an
        earlier piece, the last one (empty B or A ids are possible) goes on in a later one."""
        a, b = a[:own_a], b[:own_b]

        def ids(values: np.ndarray) -> str:
            return ",".join(map(str, values.tolist()))

        inner_a, inner_b = (group_a > 0) & (group_a < closed), (group_b > 0) & (group_b < closed)
        middle = self.groups(a[inner_a], b[inner_b], group_a[inner_a], group_b[inner_b])
        if not closed:
            return [ids(a), ids(b)]
        return [
            ids(a[group_a == 0]), ids(b[group_b == 0]), middle,
            ids(a[group_a == closed]), ids(b[group_b == closed]),
        ]


def stitch(pieces: Iterable[list[str]]) -> str:
    """The groups of a document from the parts of its pieces, in order."""
    out, open_a, open_b = [], [], []
    for first_a, first_b, *rest in pieces:
        open_a.append(first_a)
        open_b.append(first_b)
        if rest:
            middle, last_a, last_b = rest
            out.append(f"{','.join(filter(None, open_a))}|{','.join(filter(None, open_b))}")
            if middle:
                out.append(middle)
            open_a, open_b = [last_a], [last_b]
    return ";".join(out)


class Tokenizers:
    """Byte-level BPE by ranks (A) and a sentencepiece model (B), with the bytes of their ids."""

    def __init__(self, ranks: Mapping[bytes, int], pattern: str, model: bytes):
        import sentencepiece
        import tiktoken

        self.first = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=dict(ranks), special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_a[rank] = token
        self.bytes_b = []
        for number in range(self.second.vocab_size()):
            piece = self.second.id_to_piece(number)
            if self.second.is_byte(number):
                self.bytes_b.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_b.append(piece.replace("▁", " ").encode())
        if len(self.bytes_b) > 1 << B_BITS or len(self.bytes_a) > 1 << (PAIR_BITS - B_BITS):
            raise ValueError("A vocabulary has too many ids.")
        self.lengths_a = np.array([*map(len, self.bytes_a)], np.int64)
        self.lengths_b = np.array([*map(len, self.bytes_b)], np.int64)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both; none where the bytes of either are not a space and the text."""
        for text, b in zip(texts, self.second.encode(texts, num_threads=1)):
            a = self.first.encode_ordinary(f" {text}") if text else []
            whole = f" {text}".encode()
            if (
                not text
                or b"".join(map(self.bytes_a.__getitem__, a)) != whole
                or b"".join(map(self.bytes_b.__getitem__, b)) != whole
            ):
                a = b = []
            yield np.array(a, np.int64), np.array(b, np.int64)


def _bucket(pairs: np.ndarray) -> np.ndarray:
    """Of a pair's number; all pairs of an A id are in one bucket."""
    return ((pairs >> B_BITS) * 0x9E3779B1 >> 12) % BUCKETS


def _packed(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _slices(pairs: list[np.ndarray]) -> list[tuple[int, bytes, bytes]]:
    """``bucket, pairs, times`` of a chunk of documents: the document's place and the pair as
    one number, distinct and rising (packed as differences), and how often it links."""
    places = np.repeat(np.arange(len(pairs)), [*map(len, pairs)])
    keys, times = np.unique(places << PAIR_BITS | np.concatenate(pairs), return_counts=True)
    buckets = _bucket(keys & ((1 << PAIR_BITS) - 1))
    out = []
    for bucket in range(BUCKETS):
        own = buckets == bucket
        if own.any():
            out.append((bucket, _packed(np.diff(keys[own], prepend=0)), _packed(times[own].astype(np.uint32))))
    return out


def _keys(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Places of documents and pairs of a slice."""
    keys = np.cumsum(_unpacked(row["pairs"], np.int64))
    return keys >> PAIR_BITS, keys & ((1 << PAIR_BITS) - 1)


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


_DIGEST_KINDS = [*[pa.int64()] * 5, pa.string()]
_SLICE_KINDS = [pa.int32(), pa.binary(), pa.binary()]


def _chunk(chunk: int, ids: pa.Array, name: str, digests: list[tuple], pairs: list[np.ndarray]):
    """A row for each document, and a row for each slice of their pairs."""
    slices = _slices(pairs) if sum(map(len, pairs)) else []
    n, m = len(digests), len(slices)
    columns = [
        pa.array([chunk] * (n + m), pa.int64()),
        pa.array([*range(n), *[-1] * m], pa.int32()),
        pa.concat_arrays([ids, pa.nulls(m, ids.type)]),
    ]
    copies = digests[0][0] if digests else 1
    rows = [*digests, *[(copies, 0, 0, 0, sum(map(len, pairs)), None)] * m]
    columns += [pa.array(values, kind) for values, kind in zip(zip(*rows), _DIGEST_KINDS)]
    rows = [*[(None, None, None)] * n, *slices]
    columns += [pa.array(values, kind) for values, kind in zip(zip(*rows), _SLICE_KINDS)]
    return pa.RecordBatch.from_arrays(
        columns, ["chunk", "at", name, *_columns(DIGESTS), *_columns(SLICE)]
    )


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def _parts(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of bounded length, with the position of the first."""
    first, held, size = 0, [], 0
    for place, text in enumerate(texts):
        held.append(text.as_py())
        size += len(held[-1])
        if size >= CHARACTERS_AT_ONCE:
            yield first, held
            first, held, size = place + 1, [], 0
    if held:
        yield first, held


def _aligning(shared):
    """Documents of one piece each: encoded, merged and packed where they lie."""

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunks = count(TaskContext.get().partitionId() << 32)
        known = Tokenizers(*shared.value)
        solver = Solver(known.lengths_a, known.lengths_b)
        ids, digests, pairs, links = [], [], [], 0
        for batch in batches:
            for first, texts in _parts(batch.column("text")):
                for a, b in known.encode(texts):
                    own, closed, group_a, group_b = solver.solve(a, b, 0, 0, len(a), len(b))
                    groups = solver.groups(a, b, group_a, group_b)
                    digests.append((1, len(a), len(b), closed, len(own), _sha256(groups)))
                    pairs.append(own)
                    links += len(own)
                ids.append(batch.column("doc_id").slice(first, len(texts)))
                if links >= LINKS_AT_ONCE:
                    yield _chunk(next(chunks), pa.concat_arrays(ids), "doc_id", digests, pairs)
                    ids, digests, pairs, links = [], [], [], 0
        if digests:
            yield _chunk(next(chunks), pa.concat_arrays(ids), "doc_id", digests, pairs)

    return align


def _cutting(shared, work: int):
    """The pieces of long documents (``key, copies, text``)."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokenizers(*shared.value)
        for batch in batches:
            for key, copies, text in zip(*[batch.column(name) for name in ("key", "copies", "text")]):
                ((a, b),) = known.encode([text.as_py()])
                ends_a, ends_b = np.cumsum(known.lengths_a[a]), np.cumsum(known.lengths_b[b])
                every = pieces_of(a, b, ends_a, ends_b, work) if len(a) else [(a, b, 0, 0, 0, 0)]
                for piece, (own_a, own_b, *numbers) in enumerate(every):
                    row = [key.as_py(), copies.as_py(), piece, own_a.astype(np.uint16).tobytes(),
                           own_b.astype(np.uint16).tobytes(), *numbers]
                    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary(),
                             pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([value], kind) for value, kind in zip(row, kinds)], _columns(PIECE)
                    )

    return cut


def _solving(lengths):
    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver(*lengths.value)
        for batch in batches:
            for row in batch.to_pylist():
                a = np.frombuffer(row["a"], np.uint16).astype(np.int64)
                b = np.frombuffer(row["b"], np.uint16).astype(np.int64)
                own_a, own_b = row["own_a"], row["own_b"]
                pairs, closed, *groups = solver.solve(a, b, row["a_start"], row["b_start"], own_a, own_b)
                parts = solver.parts(a, b, own_a, own_b, closed, *groups)
                values = [row["key"], row["copies"], row["piece"], own_a, own_b, closed, len(pairs), parts, _packed(pairs)]
                kinds = [pa.binary(), pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.list_(pa.string()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value], kind) for value, kind in zip(values, kinds)], _columns(SOLVED)
                )

    return solve


def _stitching():
    chunks: list = []

    def document(pieces: pa.Table) -> pa.Table:
        from pyspark import TaskContext

        if not chunks:
            # Apart from the chunks of short documents.
            chunks.append(count(1 << 61 | TaskContext.get().partitionId() << 32))
        rows = sorted(pieces.to_pylist(), key=lambda row: row["piece"])
        sums = [sum(row[name] for row in rows) for name in ("n_a", "n_b", "closed", "n_links")]
        digest = (rows[0]["copies"], *sums, _sha256(stitch(row["groups"] for row in rows)))
        pairs = np.concatenate([_unpacked(row["pairs"], np.int64) for row in rows])
        return pa.Table.from_batches(
            [_chunk(next(chunks[0]), pa.array([rows[0]["key"]], pa.binary()), "key", [digest], [pairs])]
        )

    return document


def _counting():
    """``pair, documents`` from slices, summed as far as a task's memory goes."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        pairs, numbers = (np.concatenate(values) for values in zip(*parts))
        order = np.argsort(pairs, kind="stable")
        pairs, numbers = pairs[order], numbers[order]
        starts = np.flatnonzero(np.diff(pairs, prepend=-1))
        return pairs[starts], np.add.reduceat(numbers, starts)

    def batch_of(pairs: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(numbers)], ["pair", "documents"])

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                pairs, numbers = np.unique(_keys(row)[1], return_counts=True)
                parts.append((pairs, numbers * row["copies"]))
                held += len(pairs)
                if held >= PAIRS_AT_ONCE:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    if held >= PAIRS_AT_ONCE // 2:
                        yield batch_of(*parts[0])
                        parts, held = [], 0
        if parts:
            yield batch_of(*merged(parts))

    return counts


def _scoring():
    """Sums of each document's links over a bucket's slices, from the counts of its pairs."""

    def score(slices: pa.Table, counts: pa.Table) -> pa.Table:
        out = []
        pairs = counts["pair"].to_numpy()
        order = np.argsort(pairs)
        pairs, documents = pairs[order], counts["documents"].to_numpy()[order]
        if len(pairs):
            starts = np.flatnonzero(np.diff(pairs >> B_BITS, prepend=-1))
            most = np.repeat(np.maximum.reduceat(documents, starts), np.diff(starts, append=len(pairs)))
            best = documents == most
        for row in slices.to_pylist():
            places, own = _keys(row)
            found = np.searchsorted(pairs, own)
            times = _unpacked(row["times"], np.uint32).astype(np.int64)
            starts = np.flatnonzero(np.diff(places, prepend=-1))
            sums = np.add.reduceat(times * documents[found], starts)
            out.append((row["chunk"], places[starts], np.add.reduceat(times * best[found], starts), sums))
        chunks = np.repeat([row[0] for row in out], [len(row[1]) for row in out]) if out else []
        columns = [np.concatenate(values) if out else [] for values in ([row[place] for row in out] for place in (1, 2, 3))]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.table(
            [pa.array(values, kind) for values, kind in zip([chunks, *columns], kinds)],
            ["chunk", "at", "n_best", "count_sum"],
        )

    return score


def _of_long_texts(texts: DataFrame, shared, lengths, work: int) -> DataFrame:
    """Documents and slices of the texts (``key, copies, text``), piece by piece."""
    pieces = texts.mapInArrow(_cutting(shared, work), PIECE).repartition("key", "piece")
    solved = pieces.mapInArrow(_solving(lengths), SOLVED)
    return solved.groupBy("key").applyInArrow(
        _stitching(), f"chunk long, at int, key binary, {DIGESTS}, {SLICE}"
    )


def alignment(
    docs: DataFrame,
    ranks: Mapping[bytes, int],
    pattern: str,
    model: bytes,
    *,
    work: int = WORK,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``.

    A encodes a space and the text by ``ranks`` and ``pattern``, B the text by the sentencepiece
    ``model``, which adds the space. Byte offsets where tokens of both end cut them into groups;
    an A and a B token whose bytes overlap are linked. A pair's count is the number of rows that
    hold it linked. ``n_best`` is how many links have the highest count of their A id, ties
    included, ``count_sum`` the sum of the counts over the links. ``groups_sha256`` is the
    digest of ``a1,a2|b1;a3|b2,b3``, the ids of the groups in order.

    Null and empty texts, and texts whose bytes either vocabulary does not give back, have no
    tokens: zeros, and an empty ``groups_sha256``. Repeated rows count as often as they are
    there, and identifiers, null or repeated, are only passed on. Texts of more than ``work``/2
    bytes are cut into pieces that many tasks merge; such texts travel once however many rows
    have them. An empty table gives an empty result; further columns are ignored, whatever they
    are called. Both vocabularies, of fixed size, go to every worker.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((dict(ranks), pattern, model))
    known = Tokenizers(ranks, pattern, model)
    lengths = spark.sparkContext.broadcast((known.lengths_a, known.lengths_b))
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    # A token has a byte at least, so these need no second piece.
    short: Column = F.octet_length("text") < work // 2
    key = F.unhex(F.sha2("text", 256)).alias("key")
    long = rows.filter(~short).select("doc_id", key, "text")
    with Stages(spark) as stages:
        near = stages(
            rows.filter(short).mapInArrow(
                _aligning(shared), f"chunk long, at int, doc_id {kind}, {DIGESTS}, {SLICE}"
            ),
            "aligned",
        )
        texts = long.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.any_value("text").alias("text"))
        far = stages(_of_long_texts(texts, shared, lengths, work), "aligned-long")
        slices = near.drop("doc_id").unionByName(far.drop("key")).filter(F.col("bucket").isNotNull())
        counted = slices.select("copies", "pairs").mapInArrow(_counting(), "pair long, documents long")
        bucket = F.pmod(
            F.shiftright(F.shiftright("pair", B_BITS) * 0x9E3779B1, 12), F.lit(BUCKETS)
        ).cast("int")
        pairs = stages(
            counted.groupBy("pair").agg(F.sum("documents").alias("documents")).withColumn("bucket", bucket),
            "pair-counts",
        )
        # All slices of a bucket together would grow with the corpus; groups of chunks do not.
        links = near.select("at", "n_links").unionByName(far.select("at", "n_links"))
        total = links.filter("at >= 0").agg(F.sum("n_links")).first()[0] or 0
        groups = 1 + total // LINKS_PER_GROUP
        grouped = slices.select(
            "chunk", "bucket", "pairs", "times", F.pmod(F.xxhash64("chunk"), F.lit(groups)).alias("group")
        )
        numbers = F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))
        every = pairs.select("*", F.explode(numbers).alias("group"))
        sums = stages(
            grouped.groupBy("bucket", "group")
            .cogroup(every.groupBy("bucket", "group"))
            .applyInArrow(_scoring(), "chunk long, at int, n_best long, count_sum long")
            .groupBy("chunk", "at")
            .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")),
            "alignment-sums",
        )

        def summed(aligned: DataFrame, name: str) -> DataFrame:
            zero = F.lit(0).cast("long")
            return aligned.filter("at >= 0").join(sums, ["chunk", "at"], "left").select(
                name, "n_a", "n_b", "n_groups", "n_links",
                F.coalesce("n_best", zero).alias("n_best"),
                F.coalesce("count_sum", zero).alias("count_sum"),
                "groups_sha256",
            )

        near_rows = stages.keep(summed(near, "doc_id"), "alignment")
        far_rows = stages.keep(summed(far, "key"), "alignment-long")
    return near_rows.unionByName(long.select("doc_id", "key").join(far_rows, "key").drop("key"))
