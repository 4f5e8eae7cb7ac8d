"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a window of tokens. Hashes of the positions that it keeps join
windows of training documents with windows of test items, so that a hit survives other tokens
at the positions that it ignores. An item's mask finds every pattern of changes that its
overlaps allow. Around each hit the aligned tokens are compared.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import pick, text_or_empty
from tidemark.staging import Stages


@dataclass(frozen=True)
class Seeds:
    """An overlap is ``window`` aligned tokens (the whole item if shorter) of which ``percent``
    of 100 agree; items of fewer than ``least`` tokens must agree as a whole. Of ``masks``, 1
    for a position that counts, an item has the first that loses no overlap (``mask_of``).
    Items of fewer than ``shortest`` tokens take no part: a lone common word is no passage. Up
    to ``broadcast_rows`` test windows are sent to all tasks, more are joined by shuffling."""

    masks: tuple[str, ...] = ("10111", "1011")
    window: int = 16
    percent: int = 80
    least: int = 6
    shortest: int = 1
    broadcast_rows: int = 1_000_000


def finds_all(mask: str, length: int, changes: int) -> bool:
    """Whether any ``changes`` of ``length`` aligned tokens leave the mask a place to hit."""
    kept = [place for place, bit in enumerate(mask) if bit == "1"]
    places = [{at + place for place in kept} for at in range(length - len(mask) + 1)]
    return bool(places) and all(
        any(hit.isdisjoint(changed) for hit in places)
        for changed in combinations(range(length), changes)
    )


@lru_cache
def mask_of(seeds: Seeds, length: int) -> str:
    """The mask of items whose overlaps are ``length`` tokens, ``window`` at most. If none of
    the set finds all, it is a run without gaps: of the tokens that agree, so many are
    neighbours in any case."""
    if length < seeds.least:
        return "1" * length
    agreeing = max(1, -(-length * seeds.percent // 100))
    changes = length - agreeing
    for mask in seeds.masks:
        if finds_all(mask, length, changes):
            return mask
    return "1" * -(-agreeing // (changes + 1))


def token_hashes(text: Column) -> Column:
    """Hashes of the runs of letters and digits, lower-cased."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")
    return F.transform(words, lambda word: F.xxhash64(word))


def _windows(tokens: DataFrame, masks: list[str], own: Column | None = None) -> DataFrame:
    """A row per window and mask (the one numbered ``own`` only, if given): the columns but
    ``tokens``, and ``at`` and ``seed``, the hash of the tokens that the mask keeps from
    there. Token arrays are not copied along."""
    kinds = len(masks)

    def seed(number: Column) -> Column:
        start = F.floor(number / kinds).cast("int")
        keys = [
            F.when(
                start + len(mask) <= F.size("tokens"),
                F.xxhash64(
                    F.lit(mask),
                    *[F.get("tokens", start + place) for place, kept in enumerate(mask) if kept == "1"],
                ),
            )
            for mask in masks
        ]
        chosen = keys[-1]
        for place, key in reversed(list(enumerate(keys[:-1]))):
            chosen = F.when(number % kinds == place, key).otherwise(chosen)
        return chosen if own is None else F.when(number % kinds == own, chosen)

    numbers = F.sequence(F.lit(0), F.size("tokens") * kinds - 1)
    seeds = F.when(F.size("tokens") > 0, F.transform(numbers, seed))
    others = [name for name in tokens.columns if name != "tokens"]
    narrow = tokens.select(*others, seeds.alias("seeds"))
    # The outer form, as the other would compute all seeds once more to drop empty arrays.
    placed = narrow.select(*others, F.posexplode_outer("seeds").alias("number", "seed"))
    at = F.floor(F.col("number") / kinds).cast("int").alias("at")
    return placed.filter(F.col("seed").isNotNull()).select(*others, at, "seed")


def _stretches(seeds: Seeds) -> Column:
    """The aligned stretches that hold a hit between ``first_at`` and ``last_at`` of the item:
    agreeing tokens, minus the place where the stretch begins in the document, and where it
    begins in the item. Positions that either side lacks do not agree."""
    width = F.least(F.lit(seeds.window), F.size("item_tokens"))
    shift = F.col("shift")
    first = F.greatest(F.col("first_at") + F.col("span") - width, F.lit(0))
    last = F.least(F.col("last_at"), F.size("item_tokens") - width)

    def stretch(begin: Column) -> Column:
        same = F.filter(
            F.sequence(begin, begin + width - 1),
            lambda p: F.when(
                p + shift >= 0, F.get("tokens", p + shift) == F.get("item_tokens", p)
            ).otherwise(False),
        )
        return F.struct(
            F.size(same).alias("agreeing"),
            (-(begin + shift)).alias("before"),
            begin.alias("begin"),
        )

    return F.transform(F.sequence(first, F.greatest(first, last)), stretch)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    seeds: Seeds,
    stages: Stages,
    *,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """``text_key, item, item_id, start, end, agreeing``: verified overlaps, in tokens of the text
    that ``text_key`` (its SHA-256) names.

    Windows join by hash with nothing but a number for their text. The few texts with hits
    are then read again, once each, to compare tokens; a number that two texts share only
    adds a comparison that fails.
    """
    texts = pick(docs, text_column).toDF("text").select(
        F.xxhash64(text_or_empty()).alias("number_of"), text_or_empty().alias("text")
    )
    items = stages(
        pick(benchmark, item_column, item_text_column)
        .toDF("item_id", "text")
        .select("item_id", token_hashes(text_or_empty()).alias("item_tokens"))
        .filter(F.size("item_tokens") >= max(1, seeds.shortest))
        # The staged number, not the identifier, names an item: that may be null or repeated.
        .withColumn("item", F.monotonically_increasing_id()),
        "benchmark-items",
    )
    width = F.least(F.lit(seeds.window), F.size("item_tokens"))
    lengths = sorted(row[0] for row in items.select(width).distinct().collect())
    # Without items one mask is as good as another.
    masks = sorted({mask_of(seeds, length) for length in lengths}) or ["1"]
    numbers = {length: masks.index(mask_of(seeds, length)) for length in lengths}

    def by_length(values: dict[int, int]) -> Column:
        pairs = [F.when(width == length, value) for length, value in values.items()]
        return F.coalesce(*pairs, F.lit(0))

    items = items.withColumn(
        "span", by_length({length: len(masks[number]) for length, number in numbers.items()})
    )
    test = stages(
        _windows(
            items.select("item", by_length(numbers).alias("kind"), F.col("item_tokens").alias("tokens")),
            masks,
            F.col("kind"),
        ).select("seed", "item", F.col("at").alias("item_at")),
        "benchmark-windows",
    )
    if test.count() <= seeds.broadcast_rows:
        test = F.broadcast(test)
    tokens = texts.select("number_of", token_hashes(F.col("text")).alias("tokens"))
    hits = (
        _windows(tokens, masks)
        .join(test, "seed")
        .groupBy("number_of", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(F.min("item_at").alias("first_at"), F.max("item_at").alias("last_at"))
    )
    hit = F.struct("item", "shift", "first_at", "last_at")
    by_text = stages(
        hits.groupBy("number_of").agg(F.collect_list(hit).alias("hits")), "seed-hits"
    )
    percent = F.when(F.size("item_tokens") < seeds.least, 100).otherwise(seeds.percent)
    compared = (
        texts.join(by_text.hint("shuffle_hash"), "number_of")
        .select(
            F.unhex(F.sha2("text", 256)).alias("text_key"),
            token_hashes(F.col("text")).alias("tokens"),
            "hits",
        )
        .select("text_key", "tokens", F.explode("hits").alias("hit"))
        .select("text_key", "tokens", "hit.*")
        .join(items, "item")
        .withColumn("needed", width)
        .withColumn("stretches", _stretches(seeds))
        .withColumn(
            "stretches",
            F.filter("stretches", lambda one: 100 * one["agreeing"] >= percent * F.col("needed")),
        )
        .filter(F.size("stretches") > 0)
        .withColumn("best", F.array_max("stretches"))
        .withColumn("last", F.array_max(F.transform("stretches", lambda one: one["begin"])))
    )
    # The last hit bounds the overlap, unless it lies beyond the last stretch that agrees.
    until = F.least(F.col("last_at") + F.col("span"), F.col("last") + F.col("needed"))
    return compared.select(
        "text_key",
        "item",
        "item_id",
        F.greatest(-F.col("best.before"), F.lit(0)).alias("start"),
        F.greatest(-F.col("best.before") + F.col("needed"), until + F.col("shift")).alias("end"),
        F.col("best.agreeing").alias("agreeing"),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    seeds: Seeds = Seeds(),
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``:
    ``doc_id, contaminated, n_items, item_id, first_token, last_token, agreeing``.

    ``item_id`` is the item with the most agreeing tokens in one overlap (the smallest of
    equals); the tokens bound all overlaps with it, the end exclusive. Rows without an overlap
    have 0 items and nulls; a null identifier of an item is reported as null beside a count
    above 0, and rows that repeat an identifier or a text are items of their own. Null and empty
    texts have no overlap, on either side. A very long text is compared around its hits only;
    one task holds its tokens. Further columns are ignored, whatever they are called. The result of a
    row depends on its text alone, so repeated rows and null identifiers are no special case.
    Empty tables give clean documents or no rows.
    """
    with Stages(docs.sparkSession) as stages:
        found = overlaps(
            docs, benchmark, seeds, stages,
            text_column=text_column, item_column=item_column, item_text_column=item_text_column,
        )
        by_item = found.groupBy("text_key", "item", "item_id").agg(
            F.max("agreeing").alias("agreeing"), F.min("start").alias("start"), F.max("end").alias("end")
        )
        # Most agreeing tokens, then the smallest item: min over (-agreeing, item).
        best = F.min(
            F.struct((-F.col("agreeing")).alias("less"), "item_id", "start", "end")
        ).alias("best")
        dirty = stages.keep(
            by_item.groupBy("text_key").agg(F.count(F.lit(1)).alias("n_items"), best),
            "contaminated-texts",
        )
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text")
    keyed = rows.select("doc_id", F.unhex(F.sha2(text_or_empty(), 256)).alias("text_key"))
    return keyed.join(dirty, "text_key", "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.col("best.item_id").alias("item_id"),
        F.col("best.start").alias("first_token"),
        F.col("best.end").alias("last_token"),
        (-F.col("best.less")).alias("agreeing"),
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds(), *, text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without an overlap, with their columns."""
    with Stages(docs.sparkSession) as stages:
        dirty = stages.keep(
            overlaps(docs, benchmark, seeds, stages, text_column=text_column)
            .select("text_key")
            .distinct(),
            "contaminated-texts",
        )
    plain = docs.toDF(*[f"_{place}" for place in range(len(docs.columns))])
    text = F.coalesce(F.col(f"_{docs.columns.index(text_column)}").cast("string"), F.lit(""))
    keyed = plain.withColumn("text_key", F.unhex(F.sha2(text, 256)))
    dirty = dirty.hint("shuffle_hash")
    return keyed.join(dirty, "text_key", "left_anti").select(*plain.columns).toDF(*docs.columns)
