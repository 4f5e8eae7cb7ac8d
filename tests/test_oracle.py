"""Every registered query with a SQL twin agrees with it by value."""

import pytest
from compare import differences, duckdb_over

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.oracle import ORACLE_SQL
from tidemark.plans.queries import QUERIES


def test_only_the_model_query_has_no_twin():
    assert set(QUERIES) - set(ORACLE_SQL) == {"gbt_forecast"}
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


# Plan nodes that would pair all rows or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, checked_warehouse, name):
    connection = duckdb_over(checked_warehouse)
    result = queries()[name](spark, checked_warehouse)
    assert differences(result, connection, ORACLE_SQL[name]) == []
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]


def test_lookback_limits_the_shipment_scan(spark, warehouse):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    result = queries()["refined_rows"](spark, warehouse)
    plan = result._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(l_shipdate,1999-10-08T00:00)" in plan
    assert "LessThan(l_shipdate,2001-11-05T00:00)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_shared_steps_are_read_once(spark, warehouse):
    result = queries()["active_clients"](spark, warehouse)
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("lineitem.parquet") == 1


def test_entry_is_the_four_row_ledger(spark):
    ledger = entry(spark)
    assert ledger.columns == [
        "archetype", "row_count", "business_smape", "threshold", "workflow_impact_flag",
    ]
    assert ledger.count() == 4


def test_published_ledger_values(spark, checked_warehouse):
    rows = queries()["cohort_ledger"](spark, checked_warehouse).collect()
    assert {row.archetype: (row.row_count, row.business_smape) for row in rows} == {
        "The Anchors": (39, 13.617584),
        "The Dials": (270, 23.994855),
        "The Spikers": (51, 90.119789),
        "The Phantoms": (264, 31.710843),
    }
