"""Deduplication of repeated line runs by a suffix array over line identifiers.

Distinct repeated lines are numbered in sorted order; prefix doubling then ranks the runs of
2, 4, 8, ... lines that begin at each position by sorting pairs of ranks. Two ranks that cover
a run from both ends name it, whatever its length, and all suffixes that begin with it: a
longest-common-prefix interval of the suffix array. Its first member stays, later copies go.
Positions whose run is not repeated leave the table at once, and doubling ends when every run
that is long enough to be deleted is covered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import pick, text_or_empty
from tidemark.staging import Stages

#: Least words of a run that is deleted when it occurs again.
MIN_WORDS = 40
#: A line ends where the next one that is not blank begins.
LINE_BREAK = r"\n(?=[^\S\n]*+\S)"
BLANK = " \t\r\n\f\x0b"


def text_lines(text: Column) -> Column:
    """Lines, each with the blank lines that follow it; joined by line ends they are the text."""
    return F.split(text, LINE_BREAK, -1)


def document_key() -> Column:
    """Orders documents by identifier, nulls first, then by text; equal rows are one."""
    return F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_key")).alias("doc")


def _positions(rows: DataFrame) -> DataFrame:
    """``doc, at, words, line, check``: a row per line, known by 96 bits of hashes."""
    # The outer form, as the other would split all texts once more to drop empty arrays.
    lines = rows.select(
        document_key(), F.posexplode_outer(text_lines(F.col("text"))).alias("at", "line")
    ).withColumn("line", F.btrim("line", F.lit(BLANK)))
    return lines.filter("line <> ''").select(
        "doc",
        "at",
        F.size(F.split("line", r"\s+")).alias("words"),
        F.xxhash64("line").alias("line"),
        F.hash("line").alias("check"),
    )


def _ranked(keys: DataFrame, names: list[str]) -> DataFrame:
    """Numbers distinct keys that occur more than once in sorted order: sampled splitters
    range-partition them, and a number holds the range and the place in it."""
    repeated = keys.groupBy(*names).agg(F.count(F.lit(1)).alias("_")).filter("_ > 1").drop("_")
    ordered = repeated.repartitionByRange(*names).sortWithinPartitions(*names)
    return ordered.withColumn("rank", F.monotonically_increasing_id())


def suffix_ranks(rows: DataFrame, longest: int, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """Positions of repeated lines, ``doc, at, words, rank``, and ranks of the runs of
    ``2 ** level`` lines from there, ``doc, at, level, rank``, up to ``longest`` lines."""
    lines = _positions(rows)
    numbers = stages(_ranked(lines, ["line", "check"]), "line-ranks")
    current = stages(
        lines.join(numbers, ["line", "check"])
        .select("doc", "at", "words", "rank")
        .dropDuplicates(["doc", "at"]),
        "line-positions",
    )
    repeated, levels = current, current.select("doc", "at", F.lit(0).alias("level"), "rank")
    level, length = 0, 1
    while 2 * length <= longest and not current.isEmpty():
        ahead = Window.partitionBy("doc").orderBy("at").rangeBetween(length, length)
        pairs = stages(
            current.select(
                "doc", "at", F.col("rank").alias("this"), F.max("rank").over(ahead).alias("next")
            ).filter("next IS NOT NULL"),
            "line-pairs",
        )
        numbers = stages(_ranked(pairs, ["this", "next"]), "line-ranks")
        current = stages(
            pairs.join(numbers, ["this", "next"]).select("doc", "at", "rank"), "line-positions"
        )
        level, length = level + 1, 2 * length
        levels = levels.unionByName(current.withColumn("level", F.lit(level)))
    return repeated, levels


def _least_runs(repeated: DataFrame, min_words: int) -> DataFrame:
    """``doc, at, length``: least runs of repeated lines with enough words, from each line on
    and up to each line. Every longer run is made of such."""
    order = Window.partitionBy("doc").orderBy("at")
    summed = repeated.select(
        "doc",
        "at",
        "words",
        F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("until"),
        (F.col("at") - F.row_number().over(order)).alias("island"),
    )
    line = F.struct("at", "until", "words", "island")
    around = summed.select(
        "*",
        F.collect_list(line).over(order.rangeBetween(0, min_words - 1)).alias("after"),
        F.collect_list(line).over(order.rangeBetween(-(min_words - 1), 0)).alias("before"),
    )
    same = lambda x: x["island"] == F.col("island")
    ends = F.filter(
        "after",
        lambda x: same(x) & (x["until"] - F.col("until") + F.col("words") >= min_words),
    )
    starts = F.filter(
        "before",
        lambda x: same(x) & (F.col("until") - x["until"] + x["words"] >= min_words),
    )
    runs = around.select(
        "doc",
        F.explode(
            F.array(
                F.struct("at", (F.array_min(ends["at"]) - F.col("at") + 1).alias("length")),
                F.struct(
                    F.array_max(starts["at"]).alias("at"),
                    (F.col("at") - F.array_max(starts["at"]) + 1).alias("length"),
                ),
            )
        ).alias("run"),
    )
    return runs.select("doc", "run.*").filter("length IS NOT NULL").distinct()


def later_copies(rows: DataFrame, min_words: int, stages: Stages) -> DataFrame:
    """``doc, cut``: the lines (numbers from 0) of each document that repeat an earlier run."""
    repeated, levels = suffix_ranks(rows, min_words, stages)
    runs = _least_runs(repeated, min_words).withColumn(
        "level", F.floor(F.log2("length") + 1e-9).cast("int")
    )
    reach = F.call_function("shiftleft", F.lit(1), F.col("level"))
    runs = runs.withColumn("end_at", F.col("at") + F.col("length") - reach)
    head = levels.withColumnRenamed("rank", "head")
    tail = levels.select("doc", F.col("at").alias("end_at"), "level", F.col("rank").alias("tail"))
    named = stages(
        runs.join(head, ["doc", "at", "level"])
        .join(tail, ["doc", "end_at", "level"])
        .select("doc", "at", "length", "head", "tail"),
        "line-runs",
    )
    name = ["length", "head", "tail"]
    intervals = stages(
        named.groupBy(*name)
        .agg(F.min(F.struct("doc", "at")).alias("first"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1")
        .drop("members"),
        "line-intervals",
    )
    later = named.join(intervals, name).filter(F.struct("doc", "at") != F.col("first"))
    covered = F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)
    return later.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_set(covered))).alias("cut"))


def _without(text: Column, cut: Column) -> Column:
    lines = text_lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut)
    return F.array_join(F.transform(kept, lambda at: F.get(lines, at)), "\n")


def deduplicate_lines(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with shortened texts, and ``n_lines`` and ``n_deleted``.

    A line goes if it lies in a run of consecutive lines of its document that has at least
    ``min_words`` words in all and that occurs earlier, in order of identifier (nulls first),
    text hash and line. Lines are compared without surrounding white space; blank lines are
    skipped and go with the line before them. The first occurrence of a line always stays.
    A null text stays null, an empty one empty. Repeated rows (same identifier and text) are
    one document and fare alike. An empty table gives an empty result. Columns of ``docs``
    that are called like the two new ones stay as well.
    """
    if min_words < 1:
        raise ValueError("min_words must be positive.")
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text")
    rows = rows.withColumn("text", text_or_empty())
    with Stages(docs.sparkSession) as stages:
        cuts = stages.keep(later_copies(rows, min_words, stages), "line-cuts")
    names = [f"_{place}" for place in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index(text_column)]
    keyed = plain.select(
        "*",
        F.struct(
            F.col(names[docs.columns.index(id_column)]).alias("doc_id"),
            F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_key"),
        ).alias("doc"),
    )
    # One plan for all sizes: texts are hashed to their cuts and not sorted.
    joined = keyed.join(cuts.hint("shuffle_hash"), "doc", "left")
    shortened = F.when(F.col("cut").isNull(), F.col(text)).otherwise(
        _without(F.col(text), F.col("cut"))
    )
    blank = F.size(F.filter(text_lines(F.coalesce(text, F.lit(""))), lambda x: F.btrim(x, F.lit(BLANK)) != ""))
    out = joined.select(
        *[shortened if name == text else F.col(name) for name in names],
        blank.alias("n_lines"),
        F.coalesce(F.size("cut"), F.lit(0)).alias("n_deleted"),
    )
    return out.toDF(*docs.columns, "n_lines", "n_deleted")
