"""Long key-value tables of a run's metrics and parameters, and its JSON artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.config import DATE, MONTH, Settings
from tidemark.functions.expressions import month_number
from tidemark.operators.cohorts import ledger_rows
from tidemark.operators.governance import GATES
from tidemark.operators.report import GATE_METRIC, config_map

# Recorded metric keys and the columns they come from.
METRICS = {
    "val_smape_target": "val_smape_target",
    "test_smape_target": "test_smape_target",
    "val_smape_volume": "val_smape_volume",
    "test_smape_volume": "test_smape_volume",
    "cmmi_hours_to_baseline": "hours_to_baseline",
    "cmmi_hours_to_evaluation": "hours_to_evaluation",
    "cmmi_artifact_completeness": "artifact_completeness",
}

#: A gzip file is read by one task: so many reports are some 0.4 GB of text.
REPORTS_PER_FILE = 100_000


def _long(runs: DataFrame, entries: dict[str, Column]) -> DataFrame:
    """One row per run and key, without a shuffle."""
    pairs = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in entries.items()]
    return runs.select("run_id", F.inline(F.array(*pairs)))


def run_metrics(decided: DataFrame) -> DataFrame:
    """Numeric metrics as ``run_id, key, value double``."""
    return _long(decided, {key: F.col(column) for key, column in METRICS.items()})


def run_parameters(
    decided: DataFrame,
    settings: Settings = Settings(),
    *,
    source: str = "",
    source_kind: str = "",
    feature_count: int = 0,
) -> DataFrame:
    """Parameters and tags as ``run_id, key, value string``."""
    columns = {
        "run_mode": F.col("run_mode"),
        "input_source_mode": F.lit(source_kind),
        "input_source": F.lit(source),
        "feature_count": F.lit(feature_count),
        "fit_partitions": F.lit(settings.fit_partitions),
        "test_days": F.lit(settings.test_days),
        "val_days": F.lit(settings.val_days),
        "dataset_version": F.col("dataset_version"),
        "model_name": F.col("model_name"),
        **{f"cmmi_{gate}": F.col(gate) for gate in GATES},
        "promotion_evidence_allowed": F.col("run_mode") != "debug",
        "promotion_gate_metric": F.lit(GATE_METRIC),
        "promotion_gate_threshold": F.lit(settings.max_smape),
        "quality_pass": F.col("quality_pass"),
        "promotion_recommendation": F.col("promotion_recommendation"),
        "promotion_block_reason": F.coalesce("promotion_block_reason", F.lit("None")),
    }
    return _long(decided, {key: column.cast("string") for key, column in columns.items()})


def _replacing(records: DataFrame, batch: str):
    """A writer that replaces what was recorded as ``batch`` and leaves the rest alone.

    A run is a batch of its own; runs that are recorded together share one, so that there is
    a folder for each recording and not for each run."""
    named = records.withColumn("batch", F.lit(batch))
    return (
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch")
    )


def record(records: DataFrame, path: str, batch: str) -> None:
    """Add a batch to a long Parquet table; recording it again leaves one copy."""
    _replacing(records, batch).parquet(path)


def write_history(client_days: DataFrame, path: str) -> None:
    """Client-days in one folder for each month of ``event_date``, which readers prune.

    Rows are dealt by month, large months to several tasks, so that a month has few files."""
    by_month = client_days.withColumn(MONTH, month_number(F.col(DATE)))
    dealt = by_month.hint("rebalance", F.col(MONTH))
    dealt.write.mode("overwrite").partitionBy(MONTH).parquet(path)


def write_ledger(ledger: DataFrame, path: str) -> None:
    ledger_rows(ledger).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_config(spark: SparkSession, settings: Settings, path: str) -> None:
    snapshot = spark.range(1).select(F.to_json(config_map(settings)).alias("value"))
    snapshot.write.mode("overwrite").text(path)


def write_report(report: DataFrame, path: str, batch: str) -> None:
    """Add a batch of reports; writing it again leaves one copy.

    Most of a report's text is the same for every run, so the files are compressed. Both copies
    are there until the new one is committed."""
    kept = {"ignoreNullFields": False, "compression": "gzip", "maxRecordsPerFile": REPORTS_PER_FILE}
    _replacing(report, batch).options(**kept).json(path)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """A stored settings snapshot as ``key, value``."""
    stored = F.from_json("value", "map<string, double>")
    return spark.read.text(path).select(F.explode(stored).alias("key", "value"))
