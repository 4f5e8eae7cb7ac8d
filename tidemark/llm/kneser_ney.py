"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model.

Symbols are the characters of a text as they stand, in any script, so the count tables grow
with the trusted text. Counts, continuation counts, discounts and back-off weights are Spark
tables grouped by n-gram and joined on contexts; none of them comes to the driver or is held
by a task. Texts are written once in compressed blocks. A block asks for its different
n-grams, which together join the tables order by order; the probabilities return to the block
and score its texts. Documents are scored by a model that has not seen them: of two folds
each is scored with the counts of the other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import pick, text_or_empty
from tidemark.staging import Stages

FOLDS = 2
#: Line ends precede every text.
LINE = ord("\n")
#: Characters of a block of texts (a longer text is a block of its own), and of a piece of
#: it that is counted at once.
BLOCK_CHARACTERS = 16_000_000
PIECE = 1_000_000


@dataclass(frozen=True)
class Quality:
    """``order`` of the model, 2 to 5 (on labelled text, 4 tells toxic texts better than 5);
    ``quantile`` of the trusted documents' perplexities, by language, up to which a document
    is accepted; ``prior`` symbols with the mean of the language that every document counts
    besides its own; ``narrowing``, the power of the length by which perplexities of trusted
    documents close in on their mean (0.5 if symbols were independent of each other), so that
    each is restated for a text of ``length`` symbols before the quantile is taken; fewest
    trusted documents of a language for a threshold of its own, which any number of
    languages may have."""

    order: int = 4
    quantile: float = 0.98
    prior: int = 100
    narrowing: float = 0.35
    length: int = 1000
    least_trusted: int = 30

    def __post_init__(self):
        if not 2 <= self.order <= 5:
            raise ValueError(f"Order must be 2 to 5: {self.order}")
        if not 0 <= self.narrowing <= 0.5:
            raise ValueError(f"Narrowing must be 0 to 0.5: {self.narrowing}")


# --- texts in blocks ---


FIELDS = ("doc_id", "lang", "key")


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in blocks: lists of their fields, all texts as one run of zstandard bytes."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        symbols = pc.utf8_length(batch.column("text")).cast(pa.int64())
        number = np.cumsum(symbols.to_numpy()) // BLOCK_CHARACTERS
        edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            rows = batch.slice(start, end - start)
            columns = [*(rows.column(name) for name in FIELDS), symbols.slice(start, end - start)]
            offsets = pa.array([0, end - start], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, column) for column in columns]
            texts = squeeze("".join(rows.column("text").to_pylist()).encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), *lists, pa.array([texts], pa.binary())],
                ["block", *FIELDS, "symbols", "texts"],
            )
            block += 1


@dataclass(frozen=True)
class Blocks:
    """``texts`` has a row for each block, in buckets of ``block``; ``trusted`` the places in
    it of its trusted texts, for blocks that have any."""

    texts: DataFrame
    trusted: DataFrame

    def marked(self) -> DataFrame:
        return self.texts.join(self.trusted.hint("shuffle_hash"), "block", "left")


def text_blocks(rows: DataFrame, trusted_ids: DataFrame, stages: Stages) -> Blocks:
    """``rows`` (doc_id, lang, text) with text hashes, written in blocks where they are read;
    only their identifiers are shuffled to the trusted ones."""
    kind = dict(rows.dtypes)["doc_id"]
    lists = f"doc_id array<{kind}>, lang array<string>, key array<long>, symbols array<long>"
    blocks = rows.withColumn("key", F.xxhash64("text")).mapInArrow(
        _blocks, f"block long, {lists}, texts binary"
    )
    texts = stages.bucketed(blocks, "kn-blocks", "block")
    members = texts.select("block", F.posexplode("doc_id").alias("place", "doc_id"))
    # A block's rows come from one Arrow batch, which bounds the list.
    trusted = (
        members.join(trusted_ids, "doc_id", "left_semi")
        .groupBy("block")
        .agg(F.collect_list("place").alias("trusted"))
    )
    return Blocks(texts, stages(trusted, "kn-trusted"))


class Windows:
    """The windows of ``order`` symbols that end at each character of a block's texts, as
    numbers that tell them apart exactly: symbols are ranked within the block, and where a
    block has too many of them for 63 bits all but the last two of a window are ranked too."""

    def __init__(self, texts: bytes, symbols: np.ndarray, order: int):
        points = np.frombuffer(
            zstandard.ZstdDecompressor().decompress(texts).decode().encode("utf-32-le"), np.uint32
        )
        ends = np.cumsum(symbols)
        pad = np.full(order - 1, LINE, np.uint32)
        padded = np.concatenate(
            [part for end, size in zip(ends, symbols) for part in (pad, points[end - size : end])] or [pad]
        )
        starts = np.cumsum([0, *(symbols + order - 1)], dtype=np.int64)[:-1]
        self.order = order
        #: Range of windows by text; those in between cross two texts.
        self.ranges = [(int(at), int(at + size)) for at, size in zip(starts, symbols)]
        self.size = len(padded) - order + 1
        present = np.zeros(0x110000, bool)
        present[padded] = True
        self.alphabet = np.flatnonzero(present).astype(np.uint32)
        self.base = len(self.alphabet)
        self.rank = np.cumsum(present, dtype=np.int32) - 1
        self.ranks = self.rank[padded]
        self.heads = None
        if self.base**order >= 2**63:
            pieces = [np.unique(self._join(place, order - 2)) for place in self._pieces()]
            self.heads = np.unique(np.concatenate(pieces))

    def _pieces(self) -> Iterator[slice]:
        for start in range(0, self.size, PIECE):
            yield slice(start, min(start + PIECE, self.size))

    def _join(self, place: slice, width: int, first: int = 0) -> np.ndarray:
        codes = np.zeros(place.stop - place.start, np.int64)
        for at in range(first, first + width):
            codes = codes * self.base + self.ranks[place.start + at : place.stop + at]
        return codes

    def _keys(self, place: slice) -> np.ndarray:
        if self.heads is None:
            return self._join(place, self.order)
        head = np.searchsorted(self.heads, self._join(place, self.order - 2))
        return head * self.base**2 + self._join(place, 2, self.order - 2)

    def counts(self, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Different n-grams (sorted numbers) and how often each fold's trusted texts hold
        them; ``groups`` has the fold of a trusted text, ``FOLDS`` for others."""
        if not self.size:
            return np.empty(0, np.int64), np.empty((FOLDS, 0), np.int64)
        kind = np.full(self.size, -1, np.int8)
        for group, (start, end) in zip(groups, self.ranges):
            kind[start:end] = group
        found = []
        for place in self._pieces():
            keys, own = self._keys(place), kind[place]
            for group in range(FOLDS + 1):
                some = np.sort(keys[own == group])
                first = np.flatnonzero(np.diff(some, prepend=-1))
                numbers = np.diff(first, append=len(some))
                found.append((group, some[first], numbers))
        every, at = np.unique(np.concatenate([keys for _, keys, _ in found]), return_inverse=True)
        totals, done = np.zeros((FOLDS + 1, len(every)), np.int64), 0
        for group, keys, numbers in found:
            totals[group, at[done : done + len(keys)]] += numbers
            done += len(keys)
        return every, totals[:FOLDS]

    def strings(self, keys: np.ndarray) -> list[str]:
        symbols = np.empty((len(keys), self.order), np.int64)
        for at in range(self.order - 1, -1, -1):
            if self.heads is not None and at == self.order - 3:
                keys = self.heads[keys]
            keys, symbols[:, at] = np.divmod(keys, self.base)
        return _strings(self.alphabet[symbols])

    def numbers(self, grams: list[str]) -> np.ndarray:
        """Numbers of n-grams that the block holds."""
        points = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32)
        ranks = self.rank[points].reshape(-1, self.order).astype(np.int64)
        weights = self.base ** np.arange(self.order, dtype=np.int64)[::-1]
        if self.heads is None:
            return ranks @ weights
        head = np.searchsorted(self.heads, ranks[:, :-2] @ weights[2:])
        return head * self.base**2 + ranks[:, -2:] @ weights[-2:]

    def losses(self, keys: np.ndarray, logs: list[np.ndarray], folds: np.ndarray) -> np.ndarray:
        """Of each text the negative sum of its windows' logarithms, those of ``keys``, in
        the fold that has not seen it."""
        place = np.argsort(keys)
        keys = keys[place]
        found = np.zeros(self.size, np.int32)
        for piece in self._pieces():
            found[piece] = np.searchsorted(keys, self._keys(piece))
        logs = [log[place] for log in logs]
        return np.array(
            [-float(logs[1 - fold][found[start:end]].sum()) for fold, (start, end) in zip(folds, self.ranges)]
        )


def _strings(grams: np.ndarray) -> list[str]:
    width = grams.shape[1]
    text = np.ascontiguousarray(grams).tobytes().decode("utf-32-le")
    return [text[at : at + width] for at in range(0, len(text), width)]


def _members(batch, place: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and folds of a block's texts. Folds go by text, so that copies are in one."""
    symbols, keys = (np.array(batch.column(name)[place].as_py(), np.int64) for name in ("symbols", "key"))
    return symbols, keys % FOLDS


# --- count tables ---


def _counting(order: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                symbols, folds = _members(batch, place)
                windows = Windows(batch.column("texts")[place].as_py(), symbols, order)
                groups = np.full(len(folds), FOLDS)
                trusted = batch.column("trusted")[place].as_py() or []
                groups[trusted] = folds[trusted]
                keys, totals = windows.counts(groups)
                block = batch.column("block")[place].as_py()
                for start in range(0, len(keys), PIECE):
                    some = slice(start, start + PIECE)
                    grams = windows.strings(keys[some])
                    columns = {f"n{fold}": pa.array(totals[fold, some]) for fold in range(FOLDS)}
                    yield pa.RecordBatch.from_pydict(
                        {"block": [block] * len(grams), "gram": grams, **columns}
                    )

    return count


def block_grams(blocks: Blocks, order: int, stages: Stages) -> DataFrame:
    """``block, gram, n0, n1``: the different n-grams of each block and how often trusted
    texts of each fold hold them there."""
    schema = "block long, gram string, n0 long, n1 long"
    return stages(blocks.marked().mapInArrow(_counting(order), schema), "kn-grams")


def count_tables(grams: DataFrame, order: int, stages: Stages) -> list[DataFrame]:
    """``gram, n0, n1`` by order from 1: occurrences in each fold for the highest order,
    below it the numbers of different symbols before an n-gram."""
    counts = grams.filter("n0 + n1 > 0").groupBy("gram")
    top = counts.agg(*[F.sum(f"n{fold}").alias(f"n{fold}") for fold in range(FOLDS)])
    tables = [stages(top, "kn-counts")]
    for size in range(order - 1, 0, -1):
        shorter = tables[0].withColumn("gram", F.expr(f"right(gram, {size})"))
        numbers = [F.count_if(F.col(f"n{fold}") > 0).alias(f"n{fold}") for fold in range(FOLDS)]
        tables.insert(0, stages(shorter.groupBy("gram").agg(*numbers), "kn-counts"))
    return tables


def discounts(counts: DataFrame) -> DataFrame:
    """One row with ``f<fold>_d1, _d2, _d3``: discounts of counts 1, 2 and more, by Chen and
    Goodman's estimates from counts of counts; where those do not exist or leave [0, count],
    the discount is half the count, at most 1. ``f<fold>_n``: the number of n-grams."""
    numbers = counts.agg(
        *[
            F.count_if(F.col(f"n{fold}") == k if k else F.col(f"n{fold}") > 0).cast("double").alias(f"c{fold}_{k}")
            for fold in range(FOLDS)
            for k in range(5)
        ]
    )

    def discount(fold: int, k: int) -> Column:
        n = lambda k: F.col(f"c{fold}_{k}")
        y = n(1) / F.nullif(n(1) + 2 * n(2), F.lit(0.0))
        value = k - (k + 1) * y * n(k + 1) / F.nullif(n(k), F.lit(0.0))
        return F.when(value.between(0, k), value).otherwise(min(k / 2, 1.0)).alias(f"f{fold}_d{k}")

    return numbers.select(
        *[discount(fold, k) for fold in range(FOLDS) for k in (1, 2, 3)],
        *[F.col(f"c{fold}_0").alias(f"f{fold}_n") for fold in range(FOLDS)],
    )


def probabilities(wanted: DataFrame, tables: list[DataFrame], stages: Stages) -> DataFrame:
    """``gram, p0, p1``: of the different n-grams ``wanted`` (gram) the probability of the
    last symbol in each fold. Order by order, they join the counts by n-gram, the sums by
    context and the probabilities of one order less by suffix. Below the first order all
    symbols of the fold and an unknown one are alike."""
    order = len(tables)
    below = None
    for size, counts in enumerate(tables, 1):
        # A single row, the same for all n-grams of an order.
        cuts = stages(discounts(counts), "kn-discounts")
        value = lambda name: cuts.select(name).scalar()

        def cut(fold: int) -> Column:
            n = F.col(f"n{fold}")
            by_count = F.when(n == 1, value(f"f{fold}_d1")).when(n == 2, value(f"f{fold}_d2"))
            return F.when(n > 0, by_count.otherwise(value(f"f{fold}_d3"))).otherwise(0.0)

        entries = counts.select("gram", *[f"n{f}" for f in range(FOLDS)], *[cut(f).alias(f"cut{f}") for f in range(FOLDS)])
        context = F.expr(f"left(gram, {size - 1})").alias("context")
        sums = [F.sum(f"{of}{f}").alias(f"{to}{f}") for f in range(FOLDS) for of, to in (("n", "total"), ("cut", "left"))]
        contexts = entries.groupBy(context).agg(*sums)
        grams = wanted.select(F.expr(f"right(gram, {size})").alias("gram"))
        grams = (grams if size == order else grams.distinct()).select("gram", context, F.expr(f"right(gram, {size - 1})").alias("suffix"))
        joined = grams.join(entries, "gram", "left").join(contexts, "context", "left")
        if below is None:
            lower = [1 / (value(f"f{fold}_n") + 1) for fold in range(FOLDS)]
        else:
            joined = joined.join(below.toDF("suffix", *[f"q{f}" for f in range(FOLDS)]), "suffix")
            lower = [F.col(f"q{fold}") for fold in range(FOLDS)]

        def interpolated(fold: int) -> Column:
            total = F.nullif(F.col(f"total{fold}"), F.lit(0))
            share = F.coalesce((F.col(f"n{fold}") - F.col(f"cut{fold}")) / total, F.lit(0.0))
            return share + F.coalesce(F.col(f"left{fold}") / total, F.lit(1.0)) * lower[fold]

        below = stages(joined.select("gram", *[interpolated(f).alias(f"p{f}") for f in range(FOLDS)]), "kn-order")
    return below


# --- scores ---


def _scoring(order: int):
    def score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        batch = blocks.combine_chunks()
        symbols, folds = _members(batch, 0)
        losses = np.zeros(len(folds))
        if answers.num_rows:
            windows = Windows(batch.column("texts")[0].as_py(), symbols, order)
            keys = windows.numbers(answers.column("gram").to_pylist())
            logs = [np.log(answers.column(f"p{fold}").to_numpy()) for fold in range(FOLDS)]
            losses = windows.losses(keys, logs, folds)
        names = (*FIELDS, "symbols")
        fields = [batch.column(name).combine_chunks().flatten() for name in names]
        return pa.table([*fields, pa.array(losses)], [*names, "loss"])

    return score


def scores(
    blocks: Blocks, grams: DataFrame, tables: list[DataFrame], stages: Stages
) -> DataFrame:
    """``doc_id, lang, key, symbols, loss`` of every row of the blocks."""
    model = probabilities(grams.select("gram").distinct(), tables, stages)
    answers = grams.select("block", "gram").join(model, "gram").select("block", "gram", "p0", "p1")
    kind = dict(blocks.texts.dtypes)["doc_id"].removeprefix("array<").removesuffix(">")
    return (
        blocks.texts.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            _scoring(len(tables)), f"doc_id {kind}, lang string, key long, symbols long, loss double"
        )
    )


def _mean_loss() -> Column:
    return (F.sum("loss") / F.nullif(F.sum("symbols"), F.lit(0))).alias("mean")


class QualityModel:
    """A fitted model, with the thresholds of its languages."""

    def __init__(self, docs: DataFrame, labels: DataFrame, settings: Quality, stages: Stages):
        self.settings = settings
        rows = pick(docs, "doc_id", "lang", "text").select(
            "doc_id", _language().alias("lang"), text_or_empty().alias("text")
        )
        trusted_ids = (
            pick(labels, "doc_id", "quality", "toxic")
            .filter("quality = 1 AND coalesce(toxic, 0) = 0")
            .select("doc_id")
            .distinct()
        )
        blocks = text_blocks(rows, trusted_ids, stages)
        grams = block_grams(blocks, settings.order, stages)
        tables = count_tables(grams, settings.order, stages)
        self.scores = stages.keep(scores(blocks, grams, tables, stages), "kn-scores")
        known = self.scores.join(trusted_ids, "doc_id", "left_semi").filter("symbols > 0")
        self.thresholds = stages.keep(self._thresholds(known, stages), "kn-thresholds")

    def _thresholds(self, known: DataFrame, stages: Stages) -> DataFrame:
        """``lang, mean, threshold``; the row of a null language holds for all others."""
        own = (
            known.groupBy("lang")
            .agg(F.count(F.lit(1)).alias("documents"), _mean_loss())
            .filter(F.col("documents") >= self.settings.least_trusted)
        )
        all_ = known.agg(_mean_loss()).withColumn("lang", F.lit(None).cast("string"))
        means = own.select("lang", "mean").unionByName(all_.select("lang", "mean"))
        pooled = known.select(F.lit(None).cast("string").alias("lang"), "symbols", "loss")
        every = known.select("lang", "symbols", "loss").unionByName(pooled)
        # A row for each language; written, so that Spark knows its size.
        means = stages(means.withColumnRenamed("lang", "of"), "kn-means")
        adjusted = every.join(means, F.col("lang").eqNullSafe(F.col("of"))).select(
            "lang", "mean", self._adjusted()
        )
        quantile = F.percentile_approx("adjusted", self.settings.quantile, 10_000)
        return adjusted.groupBy("lang", "mean").agg(quantile.alias("threshold"))

    def _adjusted(self) -> Column:
        """Logarithm of the perplexity, restated for the length that all are compared at."""
        settings = self.settings
        symbols = F.col("symbols") + settings.prior
        width = F.pow(symbols / (settings.length + settings.prior), F.lit(settings.narrowing))
        excess = (F.col("loss") - F.col("symbols") * F.col("mean")) / symbols
        return (F.col("mean") + excess * width).alias("adjusted")

    def judged(self, scored: DataFrame) -> DataFrame:
        """Adds ``perplexity, threshold, accepted`` to rows with ``lang, symbols, loss``.

        The threshold is the language's own or the common one. There is one row for each
        language; Spark broadcasts them by their measured size and splits a large language
        otherwise."""
        own = self.thresholds.filter("lang IS NOT NULL").select(
            F.col("lang").alias("_lang"), F.col("mean").alias("_mean"), F.col("threshold").alias("_own")
        )
        common = self.thresholds.filter("lang IS NULL")
        joined = scored.join(own, F.col("lang") == F.col("_lang"), "left")
        joined = joined.withColumn(
            "mean", F.coalesce("_mean", common.select("mean").scalar())
        ).withColumn("limit", F.coalesce("_own", common.select("threshold").scalar()))
        adjusted = self._adjusted()
        return joined.select(
            *scored.columns,
            F.when(F.col("symbols") > 0, F.exp(adjusted)).alias("perplexity"),
            F.exp("limit").alias("threshold"),
            (
                (F.col("symbols") > 0)
                & F.coalesce(adjusted <= F.col("limit"), F.col("limit").isNull())
            ).alias("accepted"),
        )


def _language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(""))


def quality_scores(
    docs: DataFrame, labels: DataFrame, settings: Quality = Quality()
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, lang, text):
    ``doc_id, lang, symbols, perplexity, threshold, accepted``.

    Trusted are the documents that ``labels`` (doc_id, quality, toxic) calls good and not
    toxic; all of them are counted. A document is accepted up to the threshold of its
    language, its perplexity restated for a common length. A null language is one of its own
    (written as empty); languages with few trusted documents share one threshold. Null and
    empty texts have no perplexity and are not accepted. Without any trusted text every other
    document is accepted. Repeated rows get equal results. An empty table gives an empty result.
    """
    with Stages(docs.sparkSession) as stages:
        model = QualityModel(docs, labels, settings, stages)
    judged = model.judged(model.scores)
    return judged.select("doc_id", "lang", "symbols", "perplexity", "threshold", "accepted")


def accepted_documents(
    docs: DataFrame, labels: DataFrame, settings: Quality = Quality()
) -> DataFrame:
    """The rows of ``docs`` that ``quality_scores`` accepts, with their columns.

    A row is accepted by its identifier, language and text, known by 64 bits."""
    with Stages(docs.sparkSession) as stages:
        model = QualityModel(docs, labels, settings, stages)
    accepted = model.judged(model.scores).filter("accepted")
    wanted = accepted.select("doc_id", "lang", "key").distinct().toDF("id", "language", "text_key")
    plain = docs.toDF(*[f"_{place}" for place in range(len(docs.columns))])
    doc_id, lang, text = (F.col(f"_{docs.columns.index(name)}") for name in ("doc_id", "lang", "text"))
    same = (
        doc_id.eqNullSafe(F.col("id"))
        & (F.coalesce(lang.cast("string"), F.lit("")) == F.col("language"))
        & (F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))) == F.col("text_key"))
    )
    # Texts are hashed to what is accepted once and not sorted.
    return plain.join(wanted.hint("shuffle_hash"), same, "left_semi").toDF(*docs.columns)
