"""Client-day and run tables derived from an order warehouse and an event log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.config import ACTUAL, CLIENT, DATE, Settings


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _shipments(
    spark: SparkSession, folder: str, since: date | None, until: date | None
) -> DataFrame:
    """Order key, day and quantity; date limits reach the scan as pushed filters."""
    day = F.col("l_shipdate").cast("date")
    rows = table(spark, folder, "lineitem")
    if since is not None:
        rows = rows.filter(day >= F.lit(since))
    if until is not None:
        rows = rows.filter(day <= F.lit(until))
    return rows.select("l_orderkey", day.alias(DATE), "l_quantity")


def _daily_sum(rows: DataFrame, key: str) -> DataFrame:
    """Volume per key and day; a dominant key is summed before it is shuffled."""
    return rows.groupBy(key, DATE).agg(F.sum("l_quantity").alias(ACTUAL))


def _day_events() -> dict[str, Column]:
    day = F.col(DATE)
    month, day_of_month = F.month(day), F.dayofmonth(day)
    black_friday = (month == 11) & (F.weekday(day) == 4) & day_of_month.between(23, 29)
    return {
        "event_month_start": (day_of_month == 1).cast("int"),
        "event_christmas_day": ((month == 12) & (day_of_month == 25)).cast("int"),
        "event_black_friday": black_friday.cast("int"),
    }


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region")
    nations = table(spark, folder, "nation")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


def _describe(daily: DataFrame, client: str) -> DataFrame:
    return daily.select(
        F.col(client).alias(CLIENT),
        DATE,
        ACTUAL,
        (F.col("r_name") == "ASIA").cast("int").alias("is_china"),
        (F.col("r_name") == "EUROPE").cast("int").alias("is_domestic"),
        *[flag.alias(name) for name, flag in _day_events().items()],
    )


def daily_volume(
    spark: SparkSession, folder: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """One row per nation and day.

    Only integer keys and the quantity travel through the large joins; names are attached
    to the aggregated rows.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    owners = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    shipped = _shipments(spark, folder, since, until).join(
        owners.select("o_orderkey", "c_nationkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    daily = _daily_sum(shipped, "c_nationkey")
    named = daily.join(_nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
    return _describe(named, "n_name")


def customer_daily(
    spark: SparkSession, folder: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """One row per customer and day."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    shipped = _shipments(spark, folder, since, until).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    daily = _daily_sum(shipped, "o_custkey")
    named = daily.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        _nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return _describe(named, "c_name")


def champions(spark: SparkSession, folder: str) -> DataFrame:
    """Nation names of three regions, repeated once per customer."""
    listed = _nations(spark, folder).filter(F.col("r_name").isin("ASIA", "EUROPE", "AMERICA"))
    customers = table(spark, folder, "customer").select("c_nationkey")
    return customers.join(listed, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias(CLIENT)
    )


def event_runs(spark: SparkSession, folder: str, settings: Settings = Settings()) -> DataFrame:
    """One run per user and day of the event log."""

    def first_time(kind: str) -> Column:
        return F.min(F.when(F.col("event_type") == kind, F.col("ts")))

    def any_of(kind: str) -> Column:
        return F.bool_or(F.col("event_type") == kind)

    events = table(spark, folder, "events").select("user_id", "ts", "event_type")
    return (
        events.groupBy("user_id", F.col("ts").cast("date").alias("day"))
        .agg(
            F.min("ts").alias("experiment_start"),
            F.coalesce(first_time("view"), F.max("ts")).alias("baseline_ready"),
            F.max("ts").alias("evaluation_complete"),
            any_of("purchase").alias("promoted"),
            (~any_of("error")).alias("artifacts_complete"),
            first_time("error").alias("drift_detected_at"),
        )
        .select(
            F.concat_ws("-", F.col("user_id"), F.col("day")).alias("run_id"),
            F.lit(settings.model_name).alias("model_name"),
            F.lit(settings.dataset_version).alias("dataset_version"),
            "experiment_start",
            "baseline_ready",
            "evaluation_complete",
            "promoted",
            "artifacts_complete",
            "drift_detected_at",
        )
    )


def _spoiled(column: Column, key: Column) -> Column:
    text = column.cast("string")
    return F.when(key % 17 == 0, "n/a").when(key % 19 == 0, "nan").otherwise(text)


def _written(day: Column, key: Column) -> Column:
    """The day as text in one of three formats; some texts look like a date and are none."""
    return (
        F.when(key % 23 == 0, F.date_format(day, "yyyy-'13'-dd"))
        .when(key % 29 == 0, F.concat(F.lit("13/40/"), F.year(day)))
        .when(key % 31 == 0, F.date_format(day, "yyyy'99'dd"))
        .when(key % 5 == 0, F.date_format(day, "yyyyMMdd"))
        .when(key % 7 == 0, F.date_format(day, "M/d/yyyy"))
        .otherwise(day.cast("string"))
    )


def text_shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Every shipment row with its date, in several formats, and its quantity as text, some of
    it unparsable."""
    key = F.col("l_orderkey")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        _spoiled(_written(F.col("l_shipdate").cast("date"), key), key).alias("preadvice_date"),
        _spoiled(F.col("l_quantity"), key + F.col("l_linenumber")).alias("parcel_volume"),
        (F.round(F.col("l_discount") * 100)).alias("median_4wk_volume"),
    )
