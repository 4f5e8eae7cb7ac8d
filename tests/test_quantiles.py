"""Bracketed quantiles equal Spark's own on any data, skew and ties included."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions.quantiles import exact_quantiles
from tidemark.staging import stage

PROBABILITIES = {"q0": 0.0, "q35": 0.35, "q50": 0.5, "q65": 0.65, "q75": 0.75, "q100": 1.0}
WANTED = {name: ("x", p) for name, p in PROBABILITIES.items()}


def _both(df, accuracy):
    own = [F.percentile("x", p).alias(name) for name, p in PROBABILITIES.items()]
    direct = df.agg(*own).first().asDict()
    bracketed = exact_quantiles(df, {"x": F.col("x")}, WANTED, accuracy=accuracy).first().asDict()
    return direct, bracketed


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.floats(-1e6, 1e6).map(lambda x: round(x, 2)), min_size=1, max_size=60))
def test_any_values(spark, values):
    df = spark.createDataFrame([(value,) for value in values], "x double")
    direct, bracketed = _both(df, accuracy=20)
    for name, p in PROBABILITIES.items():
        wanted = np.quantile(values, p)
        assert direct[name] == pytest.approx(wanted, abs=1e-6)
        assert bracketed[name] == pytest.approx(wanted, abs=1e-6)


def test_rows_beyond_the_sketch_accuracy(spark):
    """Many rounds: a coarse sketch over distinct values with one value on a third of rows."""
    rows = spark.range(60_000, numPartitions=8)
    spread = (F.col("id") * 7919) % 60_000 / F.lit(7.0)
    hot = F.when(F.col("id") % 3 == 0, F.lit(1234.5)).otherwise(spread)
    missing = F.when(F.col("id") % 100 == 1, None).otherwise(hot)
    df = stage(rows.select(missing.alias("x")), "values")
    direct, bracketed = _both(df, accuracy=50)
    assert bracketed == direct


def test_ranks_next_to_a_hot_value(spark):
    values = [0.0] * 500 + [1.0] * 1000 + [1.5 + i / 1000 for i in range(1500)]
    df = stage(spark.createDataFrame([(v,) for v in values], "x double"), "values")
    wanted = {f"q{i}": ("x", i / 2999) for i in (499, 500, 501, 1499, 1500, 1501, 2999)}
    got = exact_quantiles(df, {"x": F.col("x")}, wanted, accuracy=20).first()
    for i in (499, 500, 501, 1499, 1500, 1501, 2999):
        assert math.isclose(got[f"q{i}"], values[i], abs_tol=1e-6)


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    direct, bracketed = _both(df, accuracy=50)
    assert set(direct.values()) == set(bracketed.values()) == {None}
