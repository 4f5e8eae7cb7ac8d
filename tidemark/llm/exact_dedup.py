"""Exact deduplication by a distributed sort of whole texts.

Sampled splitters range-partition the texts, an external sort puts equal texts next to each
other, and comparisons of whole neighbouring texts form the groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import pick, shuffle_partitions, text_or_empty
from tidemark.staging import Stages


#: Characters of a text that its place in the order of ranges depends on.
BEGINNING = 16


def exact_groups(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    normalise=lambda text: text,
    keep: str = "smallest",
    salts: int | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of rows with equal normalised texts the one with the smallest (or ``keep="largest"``)
    identifier stays. A null text counts as empty. A null identifier loses against any other;
    a group of only such rows has a null ``keep_id``. Of repeated rows (same identifier and
    text) one is kept. An empty table gives an empty result.

    Splitters are sampled from short sort keys: the beginning of the text, a hash of all of it
    and a salt from the identifier, so that they can cut a group of copies that holds much of
    the table into up to ``salts`` (by default the number of shuffle partitions) adjacent
    pieces, and no text travels to the driver, however long texts are. Within a range whole
    texts are sorted and compared. The pieces of a group, at most ``salts`` narrow rows, are
    then merged by the digest of their text. Further columns are ignored, whatever they are
    called.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    spark = docs.sparkSession
    best = F.max if keep == "largest" else F.min
    order: Column = (F.desc_nulls_last if keep == "largest" else F.asc_nulls_last)("doc_id")
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text")
    keyed = rows.select(
        "doc_id",
        normalise(text_or_empty()).alias("text"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts or shuffle_partitions(spark))).alias("salt"),
    ).select("*", F.substring("text", 1, BEGINNING).alias("beginning"), F.xxhash64("text").alias("hash"))
    ranged = keyed.repartitionByRange("beginning", "hash", "salt")
    piece = Window.partitionBy("beginning", "hash", "salt", "text")
    with Stages(spark) as stages:
        pieces = stages(
            ranged.select(
                "doc_id",
                "salt",
                F.row_number().over(piece.orderBy(order)).alias("place"),
                best("doc_id").over(piece).alias("piece_keep"),
                F.count(F.lit(1)).over(piece).alias("piece_size"),
                F.unhex(F.sha2("text", 256)).alias("digest"),
            ),
            "exact-pieces",
        )
        group = Window.partitionBy("digest")
        merged = (
            pieces.filter("place = 1")
            .select("digest", "salt", "piece_keep", "piece_size")
            .withColumn("keep_id", best("piece_keep").over(group))
            .withColumn("group_size", F.sum("piece_size").over(group))
            .select("digest", "salt", "keep_id", "group_size")
        )
        members = pieces.select("digest", "salt", "doc_id", "place")
        return stages.keep(
            members.join(merged, ["digest", "salt"]).select(
                "doc_id",
                "keep_id",
                "group_size",
                (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("place") == 1)).alias("kept"),
                F.lower(F.hex("digest")).alias("text_sha256"),
            ),
            "exact-groups",
        )
