"""Operational cohorts: cutpoints, labels, ledger and the gate verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.config import (
    ACTUAL,
    ANCHORS,
    BASELINE,
    DATE,
    DIALS,
    PHANTOMS,
    SPIKERS,
    ZONE_CRITICAL,
    ZONE_NOMINAL,
    ZONE_WARNING,
    Settings,
)
from tidemark.functions.expressions import deviation_signal, smape, with_row
from tidemark.functions.quantiles import exact_quantiles
from tidemark.operators.model import PREDICTED_VOLUME

CUTS = ("high_volume_cut", "low_volume_cut", "low_predictability_cut", "high_predictability_cut")


def _volume() -> Column:
    return F.coalesce(F.col(BASELINE), F.lit(0.0))


def _signal() -> Column:
    return deviation_signal(F.coalesce(F.col(ACTUAL), F.lit(0.0)), _volume())


def cohort_cutpoints(
    reference: DataFrame, settings: Settings = Settings(), **quantile_options
) -> DataFrame:
    """One row of exact volume and signal quantiles over the training rows."""
    wanted = {
        "high_volume_cut": ("volume", settings.high_volume_quantile),
        "low_volume_cut": ("volume", settings.low_volume_quantile),
        "low_predictability_cut": ("signal", settings.low_predictability_quantile),
        "high_predictability_cut": ("signal", settings.high_predictability_quantile),
    }
    measures = {"volume": _volume(), "signal": _signal()}
    return exact_quantiles(reference, measures, wanted, **quantile_options)


def label_cohorts(
    df: DataFrame, cutpoints: DataFrame | None = None, settings: Settings = Settings()
) -> DataFrame:
    """Add ``archetype``; without cutpoints they come from ``df`` itself.

    The cutpoints enter as a scalar subquery. Low volume overrides everything, and a row
    that ties both signal cuts is unpredictable.
    """
    cutpoints = cohort_cutpoints(df, settings) if cutpoints is None else cutpoints
    flagged = F.coalesce(F.col("is_china"), F.lit(0)) > 0 if "is_china" in df.columns else F.lit(False)
    high_volume, low_volume, erratic, steady = [F.col(f"_cuts.{cut}") for cut in CUTS]
    large = _volume() >= high_volume
    labelled = with_row(df, cutpoints, "_cuts").withColumn(
        "archetype",
        F.when(_volume() <= low_volume, PHANTOMS)
        .when(large & ((_signal() >= erratic) | flagged), SPIKERS)
        .when(large & (_signal() <= steady) & ~flagged, ANCHORS)
        .otherwise(DIALS),
    )
    return labelled.drop("_cuts")


def cohort_daily(labelled: DataFrame, date: str = DATE) -> DataFrame:
    """Daily totals per cohort: what planners act on."""
    return labelled.groupBy("archetype", date).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(ACTUAL).alias("actual_total"),
        F.sum(PREDICTED_VOLUME).alias("predicted_total"),
    )


def cohort_table(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """The configured cohorts, one row each, in gate order."""
    rows = [
        F.struct(
            F.lit(ordinal).alias("ordinal"),
            F.lit(cohort.name).alias("archetype"),
            F.lit(float(cohort.max_smape)).alias("threshold"),
            F.lit(cohort.hard).alias("hard"),
            F.lit(cohort.reason).alias("reason"),
        )
        for ordinal, cohort in enumerate(settings.cohorts)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def cohort_ledger(labelled: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per configured cohort, including those without data.

    SMAPE is taken over daily totals. An empty cohort has a NULL SMAPE and is nominal.
    """
    accuracy = (
        cohort_daily(labelled)
        .groupBy("archetype")
        .agg(
            F.sum("row_count").alias("row_count"),
            smape(F.col("actual_total"), F.col("predicted_total")).alias("business_smape"),
        )
    )
    breached = F.col("business_smape") > F.col("threshold")
    # The aggregate has at most one row per cohort, so it may always be broadcast.
    joined = cohort_table(labelled.sparkSession, settings).join(
        F.broadcast(accuracy), "archetype", "left"
    )
    return joined.select(
        "ordinal",
        "archetype",
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
        "business_smape",
        "threshold",
        "hard",
        "reason",
        F.when(breached & F.col("hard"), ZONE_CRITICAL)
        .when(breached, ZONE_WARNING)
        .otherwise(ZONE_NOMINAL)
        .alias("workflow_impact_flag"),
    )


def ledger_rows(ledger: DataFrame) -> DataFrame:
    """The ledger's published columns."""
    return ledger.select(
        "archetype", "row_count", "business_smape", "threshold", "workflow_impact_flag"
    )


def gate_verdict(ledger: DataFrame) -> DataFrame:
    """One row: does any hard cohort breach, and why.

    ``block_reason`` is that of the last breached hard cohort in gate order;
    ``breached_cohorts`` names every breached cohort.
    """
    flag = F.col("workflow_impact_flag")
    critical = flag == ZONE_CRITICAL
    breached = F.array_sort(
        F.collect_list(F.when(flag != ZONE_NOMINAL, F.struct("ordinal", "archetype")))
    )
    return ledger.agg(
        (~F.bool_or(critical)).alias("cohorts_pass"),
        F.max_by(F.when(critical, F.col("reason")), F.when(critical, F.col("ordinal"))).alias(
            "block_reason"
        ),
        F.bool_or(flag == ZONE_WARNING).alias("deviation_warning"),
        F.array_join(breached["archetype"], ", ").alias("breached_cohorts"),
    )


def soft_reason(settings: Settings) -> str | None:
    """The warning shown when only soft cohorts breach."""
    return next((cohort.reason for cohort in settings.cohorts if not cohort.hard), None)
