"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone; others may differ from them by case only, or repeat them."""
    positions = {name: df.columns.index(name) for name in reversed(df.columns)}
    missing = [name for name in names if name not in positions]
    if missing:
        raise ValueError(f"Columns not found: {missing}")
    numbered = df.toDF(*[f"_{position}" for position in range(len(df.columns))])
    return numbered.select(*[F.col(f"_{positions[name]}").alias(name) for name in names])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
