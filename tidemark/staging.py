"""Stage tables: cut lineage by writing a result once to the cluster's shared folder.

A stage table survives the loss of any executor, keeps Parquet column pruning and
filter pushdown for its readers, and answers ``count()`` from file footers. All stages
of an application lie in one folder, which goes when the application ends; what is no
longer read can be dropped earlier.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def stage_root(spark: SparkSession) -> str:
    """This application's folder below the shared one that the session names.

    Without ``spark.checkpoint.dir`` the warehouse, shared as well, holds the folder.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None) or f"{spark.conf.get(WAREHOUSE_DIR)}/_stages"
    root = f"{shared.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"
    location, files = file_system(spark, root)
    if not files.exists(location):
        files.mkdirs(location)
        files.deleteOnExit(location)
    return root


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused location below the application's folder."""
    return f"{stage_root(spark)}/{label}-{uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    location, files = file_system(spark, path)
    files.delete(location, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a reader over the written table."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Stages:
    """Stage tables of one run: ``with Stages(spark) as stages`` drops them at the end.

    ``keep`` writes a table that outlives the block, for results that are read lazily.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.tables: list[str] = []

    def __enter__(self) -> Stages:
        return self

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        path = stage_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, label: str, column: str) -> DataFrame:
        """A stage table in buckets of ``column``, as many as shuffles have partitions, so that
        what is joined or grouped by it later moves to these rows and they stay."""
        path, name = stage_path(self.spark, label), f"tidemark_{uuid4().hex}"
        self.paths.append(path)
        self.tables.append(name)
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.bucketBy(buckets, column).option("path", path).saveAsTable(name, format="parquet")
        return self.spark.table(name)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        return stage(df, label)

    def __exit__(self, *_) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables.clear()
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths.clear()
