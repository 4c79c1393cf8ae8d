"""Coverage, validation, inspection and cleanup of the warehouse."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tripmill.functions import month_text


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every month from ``start`` to ``end``, both included."""
    first, last = date.fromisoformat(f"{start}-01"), date.fromisoformat(f"{end}-01")
    if first > last:
        raise ValueError("start month must not be after end month")
    months = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 MONTH")))
    return (
        spark.range(1)
        .select(months.alias("first_day"))
        .select(
            month_text("first_day").alias("dataset_month"),
            F.year("first_day").alias("year"),
            F.month("first_day").alias("month"),
        )
    )


def month_coverage(landed: DataFrame, start: str, end: str) -> DataFrame:
    """Landed rows per calendar month; a month without data is reported as missing."""
    counts = landed.groupBy("dataset_month").agg(F.count("*").alias("rows"))
    spine = month_spine(landed.sparkSession, start, end)
    return spine.join(counts, "dataset_month", "left").select(
        "dataset_month", "year", "month", "rows", F.col("rows").isNotNull().alias("available")
    )


def boundary_split(gold: DataFrame, fact_months: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Gold rows by date whose month has facts, and those whose month has none."""
    dated = gold.withColumn("dataset_month", month_text("trip_date"))
    kept = dated.join(fact_months, "dataset_month", "left_semi").drop("dataset_month")
    stray = dated.join(fact_months, "dataset_month", "left_anti").drop("dataset_month")
    return kept, stray


def fact_months(fact: DataFrame) -> DataFrame:
    return fact.select("dataset_month").distinct()


def require_fact_months(months: DataFrame) -> None:
    if months.isEmpty():
        raise RuntimeError("the fact table holds no month, so every mart row would count as stray; nothing was removed")


def boundary_cleanup(gold: Mapping[str, DataFrame], months: DataFrame) -> DataFrame:
    """Rows before, after and removed, per mart, in one pass over each mart."""
    marked = months.withColumn("has_facts", F.lit(True))
    reports = [
        mart.select(month_text("trip_date").alias("dataset_month"))
        .groupBy("dataset_month")
        .agg(F.count("*").alias("n"))
        .join(marked, "dataset_month", "left")
        .agg(
            F.sum("n").alias("rows_before"),
            F.sum(F.when(F.col("has_facts"), F.col("n")).otherwise(0)).alias("rows_after"),
            F.sum(F.when(F.col("has_facts"), 0).otherwise(F.col("n"))).alias("deleted_rows"),
        )
        .select(F.lit(name).alias("model"), "rows_before", "rows_after", "deleted_rows")
        for name, mart in gold.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def year_validation(fact: DataFrame, daily: DataFrame, year: int) -> DataFrame:
    """Facts, trips, months and gold days of a year, and whether the facts are sound.

    One pass: trips are grouped by id and carry their count, first and last month
    and a bit per calendar month, so nothing is expanded for a second distinct.
    """
    facts = fact.where(F.col("dataset_month").between(f"{year}-01", f"{year}-12"))
    month_bit = F.expr("shiftleft(1, CAST(substring(dataset_month, 6, 2) AS INT))")
    sound = (
        facts.groupBy("trip_id")
        .agg(
            F.count("*").alias("n"),
            F.bit_or(month_bit).alias("months"),
            F.min("dataset_month").alias("first"),
            F.max("dataset_month").alias("last"),
        )
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"),
            F.count("trip_id").alias("unique_trips"),
            F.coalesce(F.bit_count(F.bit_or("months")), F.lit(0)).cast("long").alias("months"),
            F.min("first").alias("first_month"),
            F.max("last").alias("last_month"),
        )
    )
    is_instant = isinstance(fact.schema["pickup_at"].dataType, TimestampType)
    days = daily.where(
        (F.col("trip_date") >= F.lit(date(year, 1, 1))) & (F.col("trip_date") < F.lit(date(year + 1, 1, 1)))
    ).agg(
        F.count("*").alias("gold_days"),
        F.min("trip_date").alias("first_gold_date"),
        F.max("trip_date").alias("last_gold_date"),
    )
    merged = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), (sound, days)
    )
    return merged.agg(*(F.max(name).alias(name) for name in merged.columns)).select(
        F.lit(year).alias("year"),
        *merged.columns,
        F.lit(is_instant).alias("pickup_is_instant"),
        ((F.col("fact_rows") == F.col("unique_trips")) & (F.col("months") == 12)).alias("valid"),
    )


def warehouse_inspect(fact: DataFrame) -> DataFrame:
    """Fact rows and distinct trips per month, and whether pickups are instants.

    Trips are counted id first, month second.
    """
    is_instant = isinstance(fact.schema["pickup_at"].dataType, TimestampType)
    return (
        fact.groupBy("dataset_month", "trip_id")
        .agg(F.count("*").alias("n"))
        .groupBy("dataset_month")
        .agg(F.sum("n").alias("fact_rows"), F.count("trip_id").alias("unique_trips"))
        .withColumn("pickup_is_instant", F.lit(is_instant))
    )


def table_counts(models: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("model"), "row_count")
        for name, df in models.items()
    ]
    return reduce(DataFrame.unionByName, counts)
