"""Whole runs, the model, sinks, and row-wise operators on a stream."""

import json
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.operators.features import feature_columns
from tidemark.operators.model import fit_forecaster, forecast, load_model, regressor, save_model
from tidemark.operators.refine import refine
from tidemark.plans.forecast import add_model_inputs, prepare, refined_client_days
from tidemark.plans.training import run_training
from tidemark.staging import stage

AS_OF = date(2001, 11, 4)
SETTINGS = Settings(as_of=AS_OF, trees=2, depth=3, expected_rows=2000, fit_partitions=4)


@pytest.fixture(scope="module")
def client_days(spark, warehouse, tmp_path_factory):
    """Refined client-days as a Parquet source of a training run."""
    path = str(tmp_path_factory.mktemp("source") / "client_days.parquet")
    refined_client_days(spark, warehouse, SETTINGS).write.parquet(path)
    return path


def test_model_is_repeatable_and_survives_saving(spark, client_days, tmp_path):
    rows = spark.read.parquet(client_days)
    prepared = prepare(rows, SETTINGS)
    features = feature_columns(prepared.columns)
    train, rest = [prepared.filter(F.col("split") == "train"), prepared.filter(F.col("split") != "train")]
    model = fit_forecaster(train, features, SETTINGS)
    again = fit_forecaster(train.repartition(3), features, SETTINGS)
    save_model(model, str(tmp_path / "model"))
    order = ["client_name", "event_date"]
    first = forecast(model, rest).orderBy(*order).collect()
    assert first == forecast(again, rest).orderBy(*order).collect()
    assert first == forecast(load_model(str(tmp_path / "model")), rest).orderBy(*order).collect()
    assert all(row.pred_volume > 0 for row in first)


def test_model_settings():
    gbt = regressor(Settings())
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize()) == (600, 8, 0.03)
    assert (gbt.getSubsamplingRate(), gbt.getFeatureSubsetStrategy()) == (0.85, "0.85")


def test_training_run_writes_everything(spark, client_days, tmp_path):
    out = str(tmp_path / "out")
    champions = spark.read.parquet(client_days).select("client_name").distinct().limit(20)
    champions = stage(champions, "champions")
    run = run_training(
        spark, client_days, out, SETTINGS, champions=champions, run_id="first", mode="debug"
    )
    assert set(run.split_sizes) == {"train", "val", "test"}
    assert "event_black_friday" in run.features and "month_sin" in run.features
    assert run.scored.select("split").distinct().count() == 2
    assert run.ledger.count() == 4

    run_training(spark, client_days, out, SETTINGS, run_id="second")
    metrics = spark.read.parquet(f"{out}/run_metrics")
    assert metrics.columns == ["run_id", "key", "value", "batch"]
    assert {row.run_id: row["count"] for row in metrics.groupBy("run_id").count().collect()} == {
        "first": 7, "second": 7,
    }
    parameters = {
        (row.run_id, row.key): row.value for row in spark.read.parquet(f"{out}/run_params").collect()
    }
    assert parameters["first", "promotion_evidence_allowed"] == "false"
    assert parameters["first", "promotion_recommendation"] == "false"
    assert parameters["second", "promotion_evidence_allowed"] == "true"
    assert parameters["second", "input_source"] == client_days
    assert parameters["second", "feature_count"] == str(len(run.features))

    ledger = spark.read.json(f"{out}/ledgers/first").collect()
    assert {row.archetype for row in ledger} == {
        "The Anchors", "The Dials", "The Spikers", "The Phantoms",
    }
    config = json.loads(spark.read.text(f"{out}/configs/first").first().value)
    assert config["MAX_DIAL_SMAPE"] == 13.0 and len(config) == 10
    reports = spark.read.json(f"{out}/reports").orderBy("executive_summary.run_id").collect()
    assert [row.executive_summary.run_id for row in reports] == ["first", "second"]
    assert len(reports[0].operational_archetype_briefing) == 4
    assert len(reports[0].stage_execution_summary) == 8
    assert reports[0].recommendation.promotion_recommendation == "reject"
    assert Path(f"{out}/models/first").exists()


def test_csv_run_without_clients_or_target(spark, tmp_path):
    """One anonymous series, as text, with the default split and two days off each week."""
    start = date(2023, 4, 11)
    lines = ["event_date,actual_volume,rolling_4w_median,is_china,is_domestic"]
    days = [start + timedelta(days=i) for i in range(203)]
    for i, day in enumerate(day for day in days if day.weekday() < 5):
        lines.append(f"{day},{31.5 + (i * i) % 47},{40 + i / 8},{int(i % 7 < 2)},{int(i > 60)}")
    source = tmp_path / "daily.csv"
    source.write_text("\ufeff" + "\n".join(lines), encoding="utf-8")
    settings = Settings(as_of=days[-1], trees=2, depth=2, fit_partitions=2)
    run = run_training(spark, str(source), str(tmp_path / "out"), settings)
    assert run.split_sizes == {"train": 85, "val": 30, "test": 30}
    assert run.features == sorted(
        [f"{prefix}_{wave}" for prefix in ("month", "dow", "doy", "woy", "dom")
         for wave in ("sin", "cos")] + ["is_china", "is_domestic"]
    )
    assert run.guardrail.first().failure_reason == "CRITICAL: DataStarvationError"
    assert sum(row.row_count for row in run.ledger.collect()) == 30


def test_table_runs_obey_the_guardrail(spark, client_days, tmp_path):
    spark.read.parquet(client_days).write.mode("overwrite").saveAsTable("default.client_days")
    strict = Settings(as_of=AS_OF, trees=2, depth=3, expected_rows=10_000_000)
    with pytest.raises(RuntimeError, match="DataStarvationError"):
        run_training(spark, "default.client_days", str(tmp_path), strict)


def test_runs_stop_without_usable_rows(spark, client_days, tmp_path):
    with pytest.raises(ValueError, match="Run mode"):
        run_training(spark, client_days, str(tmp_path), SETTINGS, mode="live")
    with pytest.raises(ValueError, match="removed every row"):
        run_training(spark, client_days, str(tmp_path), Settings(as_of=date(2030, 1, 1)))
    empty = str(tmp_path / "empty.parquet")
    spark.read.parquet(client_days).limit(0).write.parquet(empty)
    with pytest.raises(ValueError, match="is empty"):
        run_training(spark, empty, str(tmp_path), SETTINGS)


def test_row_wise_operators_run_on_a_stream(spark, client_days, tmp_path):
    source = spark.read.parquet(client_days)
    batch = add_model_inputs(refine(source, SETTINGS), SETTINGS)
    stream = spark.readStream.schema(source.schema).parquet(client_days)
    out = str(tmp_path / "streamed")
    query = (
        add_model_inputs(refine(stream, SETTINGS), SETTINGS)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    order = ["client_name", "event_date"]
    streamed = spark.read.parquet(out).select(batch.columns).orderBy(*order).collect()
    assert streamed == batch.orderBy(*order).collect()
