"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``; each accepts null and empty texts, repeated rows, empty tables and further
columns as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import table
from tidemark.llm.decontaminate import clean_documents
from tidemark.llm.jaccard_join import one_of_each_group
from tidemark.llm.kneser_ney import accepted_documents
from tidemark.llm.line_dedup import deduplicate_lines
from tidemark.llm.queries import token_digests
from tidemark.staging import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity their language accepts; null and empty texts go."""
    return accepted_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs, ``n_chars`` of what is left.

    A document of which nothing but white space is left goes; others stay, empty or not."""
    names = [f"_{place}" for place in range(len(docs.columns))]
    shorter = deduplicate_lines(docs).toDF(*names, "n_lines", "n_deleted")
    left = shorter.filter(~((F.col("n_deleted") > 0) & (F.col("n_deleted") == F.col("n_lines"))))
    if "n_chars" in docs.columns:
        chars, text = (names[docs.columns.index(name)] for name in ("n_chars", "text"))
        size = F.char_length(text).cast(dict(left.dtypes)[chars])
        left = left.withColumn(chars, F.when(F.col("n_deleted") > 0, size).otherwise(F.col(chars)))
    return left.select(*names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near copies."""
    return one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text."""
    return token_digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", tokens),
]

#: Perplexities and BPE ids are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
