"""Sharding by weighted rendezvous hashing.

Every (key, shard) pair has a fixed score; a key goes to its best shard. A further shard
takes exactly the keys that it wins, and no other key moves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import pick, text_or_empty
from tidemark.staging import Stages

#: Hexadecimal digits of the hash that a double represents exactly.
HASH_DIGITS = 13
#: Bytes that a row counts besides its text.
ROW_OVERHEAD = 16


def shard_scores(key: Column, shards: Mapping[int, float]) -> Column:
    """Array of (score, shard) in the order of ``shards``; the smallest score wins.

    The score is an exponential variate with the shard's weight as its rate, drawn from a
    hash of key and shard, so that a shard wins a share in proportion to its weight.
    """
    if not shards or any(weight <= 0 for weight in shards.values()):
        raise ValueError("Shards need positive weights.")
    members = F.array(
        *[
            F.struct(F.lit(int(shard)).alias("shard"), F.lit(float(weight)).alias("weight"))
            for shard, weight in shards.items()
        ]
    )
    text = F.coalesce(key.cast("string"), F.lit(""))

    def score(member: Column) -> Column:
        digest = F.md5(F.concat(text, F.lit(":"), member["shard"].cast("string")).cast("binary"))
        number = F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")
        draw = -F.log((number + 0.5) / float(16**HASH_DIGITS))
        return F.struct((draw / member["weight"]).alias("score"), member["shard"].alias("shard"))

    return F.transform(members, score)


def best_shard(scores: Column) -> Column:
    """The winner; equal scores go to the smaller shard number."""
    return F.array_min(scores)["shard"]


def assign_shards(
    docs: DataFrame,
    shards: Mapping[int, float] | Sequence[int],
    grown: Mapping[int, float] | None = None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``slot`` numbers the rows of a shard without gaps from 0, by doc_id, checksum and size.
    Rows with a null or repeated identifier follow the same rule: the identifier alone
    decides the shard. A null text has no bytes and the checksum 0. ``grown`` adds shards for
    ``grown_shard`` (null without them). An empty table gives an empty result.

    Shards are scored where the rows are read, so that only narrow rows are ordered. Slots need
    no shard in one task: rows are range-partitioned by identifier, numbered
    within (range, shard), and shifted by the counts of earlier ranges. Rows alike in every
    sort column are told apart by the partition they came from, so that the splitters can
    divide them as well.
    """
    weights = dict(shards) if isinstance(shards, Mapping) else {shard: 1.0 for shard in shards}
    spark = docs.sparkSession
    rows = pick(docs, id_column, text_column).toDF("doc_id", "text")
    scores = shard_scores(F.col("doc_id"), weights | dict(grown or {}))
    narrow = (
        rows.select(
            "doc_id",
            (F.octet_length(text_or_empty()) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
            F.spark_partition_id().alias("origin"),
            scores.alias("scores"),
        )
        .withColumn("shard", best_shard(F.slice("scores", 1, len(weights))))
        .withColumn("grown_shard", best_shard(F.col("scores")) if grown else F.lit(None).cast("int"))
        .drop("scores")
    )
    local = Window.partitionBy("range", "shard").orderBy("doc_id", "text_crc32", "size")
    with Stages(spark) as stages:
        # Written before the splitters are sampled, which reads the rows a second time.
        keyed = (
            stages(narrow, "rendezvous-scored")
            .repartitionByRange("doc_id", "text_crc32", "size", "origin")
            .withColumn("range", F.spark_partition_id())
            .drop("origin")
        )
        numbered = stages(
            keyed.withColumn("place", F.row_number().over(local) - 1), "rendezvous-numbered"
        )
        before = Window.partitionBy("shard").orderBy("range").rowsBetween(
            Window.unboundedPreceding, -1
        )
        counts = numbered.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("rows"))
        starts = counts.select(
            "shard", "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
        )
        return stages.keep(
            numbered.join(starts, ["shard", "range"]).select(
                "doc_id",
                "size",
                "text_crc32",
                F.lit("key").alias("law"),
                "shard",
                (F.col("start") + F.col("place")).cast("long").alias("slot"),
                "grown_shard",
            ),
            "rendezvous-slots",
        )
