"""Counts on the one pass, guards in the plan, folders by month, records that stay single."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.config import MONTH, Settings
from tidemark.errors import CheckFailed, EmptyTable, MissingColumns, TooLittleHistory, VolumeRejected
from tidemark.operators.features import restore_volume
from tidemark.operators.guardrail import counted_guardrail, enforce_guardrail, guardrail
from tidemark.operators.model import fit_layout
from tidemark.operators.refine import drop_counts, observed_refine, refine
from tidemark.operators.split import part_rows, require_all_parts, split_bounds, label_split
from tidemark.operators.validate import enforce_counts, run_checks, violations
from tidemark.plans import training
from tidemark.plans.forecast import warehouse_client_days
from tidemark.sinks import record, write_history
from tidemark.sources import project_canonical, require_rows
from tidemark.staging import stage, stage_path

AS_OF = date(2001, 11, 4)
SETTINGS = Settings(as_of=AS_OF, trees=2, depth=2, expected_rows=2000)


@pytest.fixture(scope="module")
def client_days(spark, warehouse, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source") / "client_days.parquet")
    warehouse_client_days(spark, warehouse, SETTINGS).write.parquet(path)
    return path


def test_observed_counts_equal_counts_of_their_own(spark, client_days):
    rows = spark.read.parquet(client_days)
    observed, seen, checked = observed_refine(rows, SETTINGS)
    staged = stage(observed, "observed")
    assert seen.get == drop_counts(rows, SETTINGS).first().asDict()
    refined = refine(rows, SETTINGS)
    want = violations(refined, run_checks()).first().asDict()
    assert checked.get == {"valid_rows": refined.count(), **want}
    order = ["client_name", "event_date"]
    assert staged.orderBy(*order).collect() == refined.orderBy(*order).collect()
    assert counted_guardrail(spark, checked.get["valid_rows"], SETTINGS).collect() == guardrail(
        refined, SETTINGS
    ).collect()


def test_a_run_reads_its_source_in_one_write(spark, client_days, tmp_path, monkeypatch):
    """Nothing is computed before the refined rows are staged, and the source may be gone then."""
    source = str(tmp_path / "daily.parquet")
    spark.read.parquet(client_days).write.parquet(source)
    labels = []

    def staged(df, label):
        out = stage(df, label)
        labels.append(label)
        if label == "refined":
            location = spark._jvm.org.apache.hadoop.fs.Path(source)
            location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)
        return out

    monkeypatch.setattr(training, "stage", staged)
    run = training.run_training(spark, source, str(tmp_path / "out"), SETTINGS, run_id="only")
    assert labels[0] == "refined" and run.split_sizes["train"] > 0


def test_first_failing_check_wins():
    counts = dict.fromkeys(run_checks(), 0)
    enforce_counts(counts)
    counts["target_missing_actual"] = 4
    counts["inverse_non_positive_baseline"] = 1
    with pytest.raises(CheckFailed, match="missing_actual failed for 4 rows"):
        enforce_counts(counts)
    counts["input_non_positive_baseline"] = 2
    counts["input_negative_actual"] = 3
    with pytest.raises(CheckFailed) as raised:
        enforce_counts(counts)
    assert (raised.value.subject, raised.value.rows) == ("negative_actual", 3)


@pytest.mark.parametrize("baseline, check", ((None, "missing_baseline"), (0.0, "non_positive_baseline")))
def test_the_plan_fails_where_a_bad_baseline_is_used(spark, tmp_path, baseline, check):
    schema = "pred_log double, rolling_4w_median double"
    rows = spark.createDataFrame([(0.0, 10.0), (0.1, baseline)], schema)
    restored = restore_volume(rows, "pred_log", "volume", guarded=True)
    assert restored.filter("rolling_4w_median > 1").collect()[0].volume == 10.0
    with pytest.raises(PySparkException, match=f"Check {check} failed"):
        restored.collect()
    assert restore_volume(rows, "pred_log", "volume").count() == 2

    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query = (
        restore_volume(stream, "pred_log", "volume", guarded=True)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    with pytest.raises(PySparkException, match=f"Check {check} failed"):
        query.awaitTermination()


def _scan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    return plan


def test_months_outside_the_range_are_not_read(spark, client_days, tmp_path):
    rows, path = spark.read.parquet(client_days), str(tmp_path / "history.parquet")
    write_history(rows, path)
    history = spark.read.parquet(path)
    assert history.count() == rows.count()
    plain = refine(rows, SETTINGS)
    looked_back = refine(history, SETTINGS)
    plan = _scan(looked_back)
    assert f"PartitionFilters: [isnotnull({MONTH}" in plan and ">= 199911)" in plan and "<= 200111)" in plan
    order = ["client_name", "event_date"]
    assert looked_back.orderBy(*order).collect() == plain.orderBy(*order).collect()

    bounds = split_bounds(rows, SETTINGS)
    tested = part_rows(history, bounds, "test")
    scans = [part.split("PushedFilters")[0] for part in _scan(tested).split("PartitionFilters: [")[1:]]
    assert any(MONTH in filters and "subquery" in filters.lower() for filters in scans), scans
    assert tested.drop(MONTH).orderBy(*order).collect() == part_rows(rows, bounds, "test").orderBy(*order).collect()


def test_recording_a_batch_again_leaves_one_copy(spark):
    path = stage_path(spark, "records")
    rows = [spark.createDataFrame([("a", "k", value)], "run_id string, key string, value double") for value in (1.0, 2.0)]
    record(rows[0], path, "first")
    record(rows[0], path, "second")
    record(rows[1], path, "first")
    assert sorted((r.batch, r.value) for r in spark.read.parquet(path).collect()) == [("first", 2.0), ("second", 1.0)]


def test_a_run_recorded_twice_leaves_one_copy(spark, client_days, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        training.run_training(spark, client_days, out, SETTINGS, run_id="same")
    assert spark.read.parquet(f"{out}/run_metrics").count() == 7
    assert spark.read.json(f"{out}/reports").count() == 1
    keys = spark.read.parquet(f"{out}/run_params")
    assert keys.count() == keys.select("key").distinct().count()
    assert keys.filter("key = 'fit_partitions'").first().value == "1"


def test_fit_layout_follows_the_rows():
    assert fit_layout(10).fit_partitions == 1
    assert fit_layout(250_001).fit_partitions == 2
    assert fit_layout(10**9).fit_partitions == 4000
    assert fit_layout(10**9, Settings(fit_partitions=16)).fit_partitions == 16


def test_guards_name_their_subject(spark, client_days):
    rows = spark.read.parquet(client_days)
    with pytest.raises(MissingColumns) as raised:
        project_canonical(rows.drop("event_date", "actual_volume"), SETTINGS)
    assert raised.value.subject == "event_date, actual_volume"
    with pytest.raises(EmptyTable, match="nothing"):
        require_rows(rows.filter(F.lit(False)), "nothing")
    with pytest.raises(VolumeRejected) as raised:
        enforce_guardrail(counted_guardrail(spark, 1, Settings(expected_rows=100)))
    assert raised.value.subject == "CRITICAL: DataStarvationError"
    recent = label_split(rows.filter("event_date > '2001-10-20'"), SETTINGS)
    with pytest.raises(TooLittleHistory, match="'train': 0"):
        require_all_parts(recent)
