"""Source dispatch: catalog table, CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from tidemark.errors import EmptyTable

KINDS = ("table", "csv", "parquet")


def source_kind(source: str) -> str:
    """By name: ``parquet`` and ``csv`` by suffix, ``table`` for other dotted names without a
    slash, else ``folder``, which ``load`` looks into."""
    path = source.replace("\\", "/").rstrip("/")
    for kind in ("csv", "parquet"):
        if path.endswith(f".{kind}"):
            return kind
    return "table" if "." in path and "/" not in path else "folder"


def _folder_kind(spark: SparkSession, source: str) -> str:
    """``parquet`` if a file in the folder is called so, at any depth, else ``csv``."""
    location = spark._jvm.org.apache.hadoop.fs.Path(source)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(location):
        return "csv"
    found = files.listFiles(location, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return "parquet"
    return "csv"


def load(
    spark: SparkSession,
    source: str,
    schema: T.StructType | None = None,
    format: str | None = None,
) -> DataFrame:
    """Open a source lazily, as ``format`` (table, csv or parquet) or as its name says.

    Without a schema a CSV is read as text: the refinement coerces every column it
    keeps, so no inference pass over the data is needed.
    """
    if format not in (None, *KINDS):
        raise ValueError(f"Unknown format {format!r}; choose from {KINDS}.")
    kind = format or source_kind(source)
    if kind == "folder":
        kind = _folder_kind(spark, source)
    if kind == "table":
        return spark.table(source)
    if kind == "parquet":
        return spark.read.parquet(source)
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(source)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when ``df`` has no row; stops reading at the first one found."""
    if df.isEmpty():
        raise EmptyTable(message, message)
    return df
