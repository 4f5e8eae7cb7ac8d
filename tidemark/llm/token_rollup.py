"""Token totals by source, language and tokenizer version, maintained by signed deltas.

A batch of changes (inserts, deletes, revised counts) is summed up to a few totals and
committed once under its name; committing it again changes nothing. Totals are the sum of all
committed batches, old ones folded into a snapshot.
"""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import pick
from tidemark.staging import file_system

KEY = ("source", "lang", "tokenizer")
SUMS = ("documents", "tokens")
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"

#: What counts as a token, by tokenizer version.
TOKENIZERS = {
    "whitespace-1": r"[^\x20\x09-\x0D]+",
    "letters-1": r"\p{L}+",
    "letters-2": r"[\p{L}\p{N}]+",
}


def count_tokens(text: Column, tokenizer: str) -> Column:
    """A null text has none."""
    matches = F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])).cast("long")
    return F.coalesce(matches, F.lit(0).cast("long"))


def token_counts(docs: DataFrame, *tokenizers: str) -> DataFrame:
    """``doc_id, source, lang`` and a column of counts for each tokenizer version.

    One row per row, repeated or not; null and empty texts have no tokens. Very long texts are
    counted whole, without an array of their tokens. An empty table gives an empty one."""
    rows = pick(docs, "doc_id", "source", "lang", "text")
    counts = [count_tokens(F.col("text"), name).alias(name) for name in tokenizers]
    return rows.select("doc_id", "source", "lang", *counts)


def signed(counts: DataFrame, tokenizer: str, sign: int) -> DataFrame:
    """Deltas of documents that come (``sign`` 1) or go (-1) with their counts."""
    return counts.select(
        F.col("source").cast("string"),
        F.col("lang").cast("string"),
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(sign).cast("long").alias("documents"),
        (sign * F.col(tokenizer)).cast("long").alias("tokens"),
    )


def inserts(counts: DataFrame, tokenizer: str) -> DataFrame:
    return signed(counts, tokenizer, 1)


def deletes(counts: DataFrame, tokenizer: str) -> DataFrame:
    return signed(counts, tokenizer, -1)


def revisions(counts: DataFrame, old: str, new: str) -> DataFrame:
    """Counts that another tokenizer version replaces: both signs, the old one negative."""
    return deletes(counts, old).unionByName(inserts(counts, new))


def _summed(deltas: DataFrame) -> DataFrame:
    """Rows combine before they are shuffled, so a frequent source is no hot key."""
    return deltas.groupBy(*KEY).agg(*[F.sum(name).alias(name) for name in SUMS])


class TokenRollup:
    """Totals below ``folder``, which all executors share.

    ``batches/<name>`` holds a committed batch, ``snapshots/<number>`` the totals of the
    batches that its ``covered`` table names. A batch or snapshot is written aside and renamed
    into place when complete, so a run that ends early leaves nothing that counts.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _names(self, kind: str) -> list[str]:
        location, files = file_system(self.spark, f"{self.folder}/{kind}")
        if not files.exists(location):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(location))

    def _publish(self, write, kind: str, name: str) -> bool:
        """False if the name is taken already."""
        target, files = file_system(self.spark, f"{self.folder}/{kind}/{name}")
        if files.exists(target):
            return False
        aside = f"{self.folder}/unfinished/{uuid4().hex}"
        write(aside)
        files.mkdirs(target.getParent())
        source, _ = file_system(self.spark, aside)
        if files.exists(target) or not files.rename(source, target):
            files.delete(source, True)
            return False
        return True

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Adds a batch of deltas (columns of ``SCHEMA``); False if it was there already.

        Null sources, languages and versions are keys of their own; null counts count 0. An
        empty batch is committed as well. Rows that repeat within a batch count as often as they
        are there; it is the batch's name that makes a replay count once. A delete of what was
        never inserted leaves negative totals, which a later insert of it evens out. Further
        columns are ignored, whatever they are called. The grouped sum is written as it is
        partitioned, by as many tasks as its keys need.
        """
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError(f"Not a batch name: {batch!r}")
        plain = pick(deltas, *KEY, *SUMS)
        filled = plain.select(
            *[F.col(name).cast("string") for name in KEY],
            *[F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long")).alias(name) for name in SUMS],
        )
        return self._publish(
            lambda path: _summed(filled).write.parquet(path), "batches", batch
        )

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(path)

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens``; totals of 0 documents and tokens
        are left out."""
        parts, batches = [], self._names("batches")
        if snapshots := self._names("snapshots"):
            last = f"{self.folder}/snapshots/{snapshots[-1]}"
            parts.append(self._read(f"{last}/totals"))
            covered = {row.batch for row in self.spark.read.parquet(f"{last}/covered").collect()}
            batches = [name for name in batches if name not in covered]
        if batches:
            paths = [f"{self.folder}/batches/{name}" for name in batches]
            parts.append(self.spark.read.schema(SCHEMA).parquet(*paths))
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return _summed(every).filter("documents <> 0 OR tokens <> 0")

    def compact(self) -> bool:
        """Folds all committed batches into a new snapshot. Batches stay, so that a replay of
        one is still known; ``totals`` reads the snapshot and what came after it."""
        batches, number = self._names("batches"), len(self._names("snapshots"))

        def write(path: str) -> None:
            self.totals().write.parquet(f"{path}/totals")
            names = self.spark.createDataFrame([(name,) for name in batches], "batch string")
            names.coalesce(1).write.parquet(f"{path}/covered")

        return self._publish(write, "snapshots", f"{number:08d}")
