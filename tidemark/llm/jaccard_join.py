"""Jaccard join of documents on word n-grams, and the groups that its links form.

The join is exact and size-aware. Two sets can only link if nearly all shingles of either
occur in other documents as well; counting shared shingles once over the whole corpus leaves
few documents. Of these, small sets are joined by enumerating subsets of the size that a
link's overlap must have, large ones by scanning inverted lists of their rarest shingles. The
boundary between both is where the estimated cost is least.

Only groups are asked for, so pairs that are already connected need no check. Each list is
first compared with its most central member, which connects most of a large group of near
copies at linear cost; lists are then scanned for pairs of different groups alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import pick, text_or_empty
from tidemark.llm.components import connected_components
from tidemark.staging import Stages

#: Text bytes whose shingles one task of the corpus count holds.
BYTES_PER_PART = 16 << 20
#: Shingles that are packed together before they are sent.
CHUNK_SHINGLES = 1 << 20
#: Documents whose counts one task adds up.
DOCUMENTS_PER_BUCKET = 20_000
#: Largest set size that may be enumerated; costs beyond are far above any list's.
ENUMERABLE = 24
#: Comparisons of lists with one member each, before all pairs of different groups.
STAR_ROUNDS = 2

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
     0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3],
    dtype=np.uint64,
)


def overlap_needed(n, m, percent: int):
    """Least intersection of linked sets with n and m elements."""
    return -(-percent * (n + m) // (100 + percent))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD[0]
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; A-Z are lower-cased, words end at
    ASCII white space. Fewer words make one shingle, none an empty set."""
    from xxhash import xxh3_64_intdigest

    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(parts))
    with np.errstate(over="ignore"):
        total = np.full(len(parts) - width + 1, width, np.uint64)
        for place in range(width):
            factor = _ODD[place % len(_ODD)] + np.uint64(2 * (place // len(_ODD)))
            total = _mixed(total + hashes[place : len(parts) - width + 1 + place] * factor)
    return np.unique(total)


def set_digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _digest64(digest: bytes) -> np.uint64:
    return np.frombuffer(digest[:8], np.uint64)[0]


# --- corpus count: how many shingles of a document occur elsewhere ----------------------


def _chunks(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for batch in batches:
        for text in batch.column("text"):
            hashes = shingle_hashes(text.as_py(), words)
            if len(hashes):
                held.append(hashes)
                size += len(hashes)
            if size >= CHUNK_SHINGLES:
                yield held
                held, size = [], 0
    if held:
        yield held


PACKED = "part int, shared binary, single binary, owners binary, counts binary"


def _packed(words: int, parts: int):
    """Shingles of a chunk of documents by part: those that several of its documents have
    once without an owner, the others with theirs."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sets in _chunks(batches, words):
            digests = np.array([_digest64(set_digest(s)) for s in sets], np.uint64)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            every = np.concatenate(sets)
            order = np.argsort(every, kind="stable")
            ordered = every[order]
            again = np.zeros(len(every), bool)
            again[1:] = ordered[1:] == ordered[:-1]
            several = again.copy()
            several[:-1] |= again[1:]
            local = np.bincount(owner[order[several]], minlength=len(sets))
            low = np.uint64(0xFFFFFFFF)
            part_of = lambda t: ((t >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            shared = ordered[several & ~again]
            shared_part = part_of(shared)
            by_part = np.argsort(shared_part, kind="stable")
            shared = (shared & low).astype(np.uint32)[by_part]
            shared_cuts = np.searchsorted(shared_part[by_part], np.arange(parts + 1))
            # Of a part: singles by owner, so that owners shrink to a count each.
            single, owners = ordered[~several], owner[order[~several]]
            single_part = part_of(single)
            by_part = np.lexsort((owners, single_part))
            single, owners = (single & low).astype(np.uint32)[by_part], owners[by_part]
            single_cuts = np.searchsorted(single_part[by_part], np.arange(parts + 1))
            rows: dict[str, list] = {
                "part": [], "shared": [], "single": [], "owners": [], "counts": []
            }
            for number in range(parts):
                a, b = shared_cuts[number : number + 2]
                c, d = single_cuts[number : number + 2]
                if a == b and c == d:
                    continue
                own, counts = np.unique(owners[c:d], return_counts=True)
                rows["part"].append(number)
                rows["shared"].append(shared[a:b].tobytes())
                rows["single"].append(single[c:d].tobytes())
                rows["owners"].append(digests[own].tobytes())
                rows["counts"].append(counts.astype(np.uint32).tobytes())
            # What the chunk counted itself: owners and counts without shingles.
            some = np.flatnonzero(local)
            if len(some):
                rows["part"].append(int(digests[0] % np.uint64(parts)))
                rows["shared"].append(b"")
                rows["single"].append(b"")
                rows["owners"].append(digests[some].tobytes())
                rows["counts"].append(local[some].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_pydict(
                rows,
                pa.schema([("part", pa.int32())] + [(c, pa.binary()) for c in list(rows)[1:]]),
            )

    return pack


def _counting(buckets: int):
    """Counts of a part by document, packed by bucket of documents."""

    def count(chunk: pa.Table) -> pa.Table:
        who, found = _shared_in_part(chunk)
        bucket = (who % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        who, found, bucket = who[order], found[order], bucket[order]
        numbers, starts = np.unique(bucket, return_index=True)
        cuts = starts[1:].tolist()
        return pa.table(
            {
                "bucket": pa.array(numbers, pa.int64()),
                "owners": pa.array([own.tobytes() for own in np.split(who, cuts)][: len(numbers)], pa.binary()),
                "counts": pa.array([own.tobytes() for own in np.split(found, cuts)][: len(numbers)], pa.binary()),
            }
        )

    return count


def _summed(chunk: pa.Table) -> pa.Table:
    who = np.concatenate([np.frombuffer(b.as_py(), np.uint64) for b in chunk["owners"]])
    counts = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in chunk["counts"]])
    owners, place = np.unique(who, return_inverse=True)
    shared = np.bincount(place, weights=counts).astype(np.int64)
    return pa.table({"digest64": owners.view(np.int64), "shared": shared})


def _shared_in_part(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Documents and how many of a part's shingles each shares with other chunks."""
    singles, owners, shared, done = [], [], [], {}
    digests: list[np.ndarray] = []
    known: list[tuple[np.ndarray, np.ndarray]] = []
    offset = 0
    for row in chunk.to_pylist():
        who = np.frombuffer(row["owners"], np.uint64)
        counts = np.frombuffer(row["counts"], np.uint32)
        if not row["single"] and len(who):
            known.append((who, counts))
            continue
        singles.append(np.frombuffer(row["single"], np.uint32))
        owners.append(np.repeat(np.arange(offset, offset + len(who)), counts))
        digests.append(who)
        offset += len(who)
        shared.append(np.frombuffer(row["shared"], np.uint32))
    who = np.concatenate(digests) if digests else np.empty(0, np.uint64)
    found = np.zeros(len(who), np.int64)
    if singles:
        token, owner = np.concatenate(singles), np.concatenate(owners)
        elsewhere = np.unique(np.concatenate(shared))
        order = np.argsort(token, kind="stable")
        ordered = token[order]
        same = np.zeros(len(token), bool)
        same[1:] = ordered[1:] == ordered[:-1]
        same[:-1] |= same[1:].copy()
        if len(elsewhere):
            place = np.minimum(np.searchsorted(elsewhere, ordered), len(elsewhere) - 1)
            same |= elsewhere[place] == ordered
        found += np.bincount(owner[order[same]], minlength=len(who))
    some = found > 0
    who = np.concatenate([who[some], *[w for w, _ in known]])
    found = np.concatenate([found[some], *[c.astype(np.int64) for _, c in known]])
    return who, found


def _sets(words: int, with_tokens: bool):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, tokens = [], [], []
            for text in batch.column("text"):
                hashes = shingle_hashes(text.as_py(), words)
                digests.append(set_digest(hashes) if len(hashes) else None)
                sizes.append(len(hashes))
                if with_tokens:
                    tokens.append(hashes.view(np.int64))
            columns = {
                "doc_id": batch.column("doc_id"),
                "text_key": batch.column("text_key"),
                "n": pa.array(sizes, pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "digest64": pa.array(
                    [int(_digest64(d).view(np.int64)) if d else None for d in digests], pa.int64()
                ),
            }
            if with_tokens:
                columns["tokens"] = pa.array(tokens, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)

    return read


NARROW = "text_key long, n long, digest binary, digest64 long"


def shared_counts(texts: DataFrame, words: int, documents: int) -> DataFrame:
    """``digest64, shared``: at least as many shingles as a set shares with other documents.

    A part compares 32 bits of a hash; a chance agreement only keeps a document longer.
    """
    size = texts.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    parts = max(1, -(-size // BYTES_PER_PART))
    packed = texts.select("text").mapInArrow(_packed(words, parts), PACKED)
    buckets = max(1, -(-documents // DOCUMENTS_PER_BUCKET))
    counted = packed.groupBy("part").applyInArrow(
        _counting(buckets), "bucket long, owners binary, counts binary"
    )
    return counted.groupBy("bucket").applyInArrow(_summed, "digest64 long, shared long")


# --- small sets: subsets -----------------------------------------------------------------


def _partners(n: int, percent: int, most: int) -> list[int]:
    return [m for m in range(1, most + 1) if 100 * min(n, m) >= percent * max(n, m)]


def subset_count(n: int, percent: int, most: int) -> int:
    """Subsets that a set of n elements makes, partners having ``most`` elements at most."""
    return sum(comb(n, overlap_needed(n, m, percent)) for m in _partners(n, percent, most))


def choose_boundary(sizes: dict[int, int], scan: float, percent: int) -> int:
    """Largest enumerated set size of least total cost. ``sizes``: sets by size, ``scan``:
    mean length of a list. A scanned list entry is compared with whole sets."""

    def cost(most: int) -> float:
        total = 0.0
        for n, sets in sizes.items():
            if n <= most:
                total += sets * subset_count(n, percent, most)
            else:
                prefix = n - -(-percent * n // 100) + 1
                total += sets * prefix * (1 + scan * n)
        return total

    return min(range(ENUMERABLE + 1), key=cost)


def _subsets(percent: int, most: int):
    def enumerate_subsets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("lo", pa.int32()), ("hi", pa.int32()), ("subset", pa.binary()),
             ("n", pa.int64()), ("digest", pa.binary())]
        )
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                n = row["n"]
                tokens = [int(t).to_bytes(8, "little", signed=True) for t in row["tokens"]]
                for m in _partners(n, percent, most):
                    for chosen in combinations(tokens, overlap_needed(n, m, percent)):
                        key = hashlib.blake2b(b"".join(chosen), digest_size=16).digest()
                        rows.append((min(n, m), max(n, m), key, n, row["digest"]))
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows))), schema=schema)
                    rows = []
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return enumerate_subsets


def small_links(sets: DataFrame, percent: int, most: int, stages: Stages) -> DataFrame:
    """Links ``a, b`` that connect all linked sets of at most ``most`` elements.

    Sets of sizes lo and hi that have a subset of the needed size in common are linked;
    each links to the smallest of the other size."""
    subsets = stages(
        sets.filter(F.col("n") <= most)
        .select("n", "digest", "tokens")
        .mapInArrow(
            _subsets(percent, most), "lo int, hi int, subset binary, n long, digest binary"
        ),
        "jaccard-subsets",
    )
    key = ["lo", "hi", "subset"]
    groups = stages(
        subsets.groupBy(*key)
        .agg(
            F.min(F.when(F.col("n") == F.col("lo"), F.col("digest"))).alias("first_lo"),
            F.min(F.when(F.col("n") == F.col("hi"), F.col("digest"))).alias("first_hi"),
            F.count(F.lit(1)).alias("members"),
        )
        .filter("members > 1 AND first_lo IS NOT NULL AND first_hi IS NOT NULL"),
        "jaccard-subset-groups",
    )
    other = F.when(F.col("n") == F.col("lo"), F.col("first_hi")).otherwise(F.col("first_lo"))
    return subsets.join(groups, key).select(F.col("digest").alias("a"), other.alias("b"))


# --- large sets: inverted lists ----------------------------------------------------------


def _may_link(left: str, right: str, percent: int, most: int) -> Column:
    """Sizes and positions in the lists allow a link, and subsets have not settled it."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    low, high = F.least(n, m), F.greatest(n, m)
    rest = F.least(n - F.col(f"{left}.place"), m - F.col(f"{right}.place"))
    return (
        (100 * low >= percent * high)
        & (high > most)
        & (rest * (100 + percent) >= percent * (n + m))
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("digest").alias("a"), F.col("tokens").alias("of_a"))
    right = sets.select(F.col("digest").alias("b"), F.col("tokens").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def inverted_lists(sets: DataFrame, percent: int, stages: Stages) -> tuple[DataFrame, dict, float]:
    """Entries ``token, digest, n, place, shared`` of the rarest shingles of each set that
    still can link, sizes of those sets up to the enumerable, and the mean list length."""
    tokens = sets.select("digest", "n", F.explode("tokens").alias("token"))
    counts = stages(
        tokens.groupBy("token").agg(F.count(F.lit(1)).alias("frequency")).filter("frequency > 1"),
        "jaccard-frequencies",
    )
    common = tokens.join(counts, "token")
    per_set = Window.partitionBy("digest")
    rank = F.row_number().over(per_set.orderBy("frequency", "token"))
    ranked = (
        common.withColumn("shared", F.count(F.lit(1)).over(per_set))
        .withColumn("rank", rank)
        .filter(100 * F.col("shared") >= percent * F.col("n"))
    )
    # Shingles of one set only come first in the order; a link needs one within the prefix.
    place = F.col("n") - F.col("shared") + F.col("rank") - 1
    prefix = F.floor((100 - percent) * F.col("n") / 100) + 1
    lists = stages(
        ranked.withColumn("place", place)
        .filter(F.col("place") < prefix)
        .select("token", "digest", "n", "place", "shared"),
        "jaccard-lists",
    )
    able = lists.select("digest", "n").distinct()
    sizes = {r.n: r["count"] for r in able.filter(F.col("n") <= ENUMERABLE).groupBy("n").count().collect()}
    mean = lists.groupBy("token").count().agg(F.avg("count")).first()[0] or 1.0
    return lists, sizes, mean


def _labelled(lists: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return lists.withColumn("root", F.col("digest"))
    known = roots.withColumnRenamed("node", "digest")
    return lists.join(known, "digest", "left").withColumn("root", F.coalesce("root", "digest"))


def group_links(sets: DataFrame, percent: int, stages: Stages) -> DataFrame:
    """``node, root`` of all sets (``digest, n, tokens``) with a link, root naming the group."""
    lists, sizes, mean = inverted_lists(sets, percent, stages)
    most = choose_boundary(sizes, mean, percent)
    able = lists.select("digest").distinct()
    links = stages(
        small_links(sets.join(able, "digest", "left_semi"), percent, most, stages), "jaccard-links"
    )
    roots = connected_components(links, stages, "jaccard-small")
    # A large set's partner may be small; sizes below cannot be one.
    lists = lists.filter(100 * F.col("n") >= percent * (most + 1))
    for number in range(STAR_ROUNDS + 1):
        entries = stages(_labelled(lists, roots), "jaccard-entries")
        if number < STAR_ROUNDS:
            # The member that shares most first; then any other, the same one in most lists.
            chosen = F.col("shared") / F.col("n") if number == 0 else F.hash("digest") + F.lit(0.0)
            member = F.struct(chosen.alias("_"), "digest", "n", "place", "root")
            hubs = stages(
                entries.groupBy("token").agg(F.max(member).alias("hub")).select("token", "hub.*"),
                "jaccard-hubs",
            )
            pairs = entries.alias("x").join(
                hubs.alias("y"),
                (F.col("x.token") == F.col("y.token"))
                & (F.col("x.root") != F.col("y.root"))
                & _may_link("x", "y", percent, most),
            )
        else:
            pairs = entries.alias("x").join(
                entries.alias("y"),
                (F.col("x.token") == F.col("y.token"))
                & (F.col("x.root") < F.col("y.root"))
                & _may_link("x", "y", percent, most),
            )
        pairs = stages(
            pairs.select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")).distinct(),
            "jaccard-pairs",
        )
        links = stages(links.union(_verified(pairs, sets, percent)), "jaccard-links")
        roots = connected_components(links, stages, "jaccard-large")
    return roots


def jaccard_groups(
    docs: DataFrame,
    *,
    words: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Two documents link when the Jaccard similarity of their sets of word n-grams reaches
    ``percent`` of 100; ``component_id`` is the smallest identifier that links reach. A text
    with fewer words makes one shingle of all of them. A null or blank text has an empty set
    and links with nothing: its ``component_id`` is its own identifier. Repeated rows have
    equal sets and so link. Null identifiers are left out of the minimum; a component of
    only such rows has a null ``component_id``. An empty table gives an empty result.

    Equal sets are joined as one. A set is known by 128 bits, a shingle by 64 bits of a hash.
    """
    groups = _classes(docs, words, percent, id_column, text_column)
    firsts = groups.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    with Stages(docs.sparkSession) as stages:
        firsts = stages.keep(firsts.filter("component IS NOT NULL"), "jaccard-firsts")
    return groups.join(firsts, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def _classes(
    docs: DataFrame, words: int, percent: int, id_column: str, text_column: str
) -> DataFrame:
    """``doc_id, text_key, n, component`` of every row; a null component is a row alone."""
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text")
    texts = rows.select(
        "doc_id", F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().alias("text")
    )
    identifier = f"doc_id {dict(rows.dtypes)['doc_id']}, "
    spark = docs.sparkSession
    with Stages(spark) as stages:
        narrow = stages(texts.mapInArrow(_sets(words, False), identifier + NARROW), "jaccard-narrow")
        shared = shared_counts(texts, words, narrow.count())
        able = stages(
            narrow.filter("n > 0")
            .join(shared, "digest64")
            .filter(100 * F.col("shared") >= percent * F.col("n"))
            .groupBy("digest")
            .agg(F.min("text_key").alias("text_key"))
            .select("text_key"),
            "jaccard-able",
        )
        once = texts.join(able.hint("shuffle_hash"), "text_key", "left_semi")
        sets = stages(
            once.mapInArrow(
                _sets(words, True), identifier + NARROW + ", tokens array<long>"
            )
            .groupBy("digest")
            .agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")),
            "jaccard-sets",
        )
        roots = group_links(sets, percent, stages).withColumnRenamed("node", "digest")
        copies = narrow.filter("n > 0").groupBy("digest").agg(F.count(F.lit(1)).alias("rows"))
        known = stages(
            copies.join(roots, "digest", "left")
            .filter("rows > 1 OR root IS NOT NULL")
            .select("digest", F.coalesce("root", "digest").alias("component")),
            "jaccard-known",
        )
        return stages.keep(
            narrow.join(known, "digest", "left").select("doc_id", "text_key", "n", "component"),
            "jaccard-classes",
        )


def one_of_each_group(
    docs: DataFrame,
    *,
    words: int = 5,
    percent: int = 80,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that lead their group or are in none, with their columns.

    The row with the smallest identifier leads, nulls last; of rows that share it the one
    with the smallest text hash; of repeated rows one. Null and blank texts are in no group.
    """
    spark = docs.sparkSession
    names = [f"_{place}" for place in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc_id = F.col(names[docs.columns.index(id_column)])
    text = F.coalesce(F.col(names[docs.columns.index(text_column)]).cast("string"), F.lit(""))
    groups = _classes(docs, words, percent, id_column, text_column)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))
    leaders = groups.filter("component IS NOT NULL").groupBy("component").agg(
        F.min(order).alias("leader")
    )
    with Stages(spark) as stages:
        leaders = stages(leaders, "jaccard-leaders")
        gone = stages.keep(
            groups.join(leaders, "component")
            .filter(order != F.col("leader"))
            .select(F.struct("doc_id", "text_key").alias("doc"))
            .distinct(),
            "jaccard-gone",
        )
        again = stages.keep(
            groups.filter("n > 0")
            .groupBy(F.struct("doc_id", "text_key").alias("doc"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .filter("rows > 1")
            .select("doc"),
            "jaccard-again",
        )
    keyed = plain.withColumn("doc", F.struct(doc_id.alias("doc_id"), F.xxhash64(text).alias("text_key")))
    left = keyed.join(gone.hint("shuffle_hash"), "doc", "left_anti")
    repeated = left.join(again, "doc", "left_semi").dropDuplicates(["doc"])
    once = left.join(again, "doc", "left_anti")
    return once.unionByName(repeated).select(*names).toDF(*docs.columns)
