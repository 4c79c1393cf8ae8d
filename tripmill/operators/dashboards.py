"""Dashboard queries over the marts and the audit table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import round_half_away, settled

TOP_ZONES, ZONE_TABLE_ROWS = 20, 25


def kpi_latest_day(daily: DataFrame) -> DataFrame:
    return (
        daily.select("trip_date", "trip_count", "revenue_amount", "average_fare_amount", "tip_rate_pct")
        .orderBy(F.col("trip_date").desc())
        .limit(1)
    )


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.select("trip_date", "trip_count", "revenue_amount").orderBy("trip_date")


def daily_trend_chart(daily: DataFrame) -> DataFrame:
    """Time series at day grain."""
    return (
        daily.groupBy(F.date_trunc("day", "trip_date").alias("day"))
        .agg(F.sum("trip_count").alias("trips"), F.sum("revenue_amount").alias("revenue"))
        .orderBy("day")
    )


def _zone_totals(zones: DataFrame) -> DataFrame:
    return zones.groupBy("zone_name", "borough").agg(
        F.sum("trip_count").alias("trip_count"), F.sum("revenue_amount").alias("revenue_amount")
    )


def top_zones(zones: DataFrame) -> DataFrame:
    return (
        _zone_totals(zones)
        .orderBy(F.col("revenue_amount").desc(), "zone_name", "borough")
        .limit(TOP_ZONES)
    )


def zone_table(zones: DataFrame) -> DataFrame:
    return (
        _zone_totals(zones)
        .orderBy(F.col("trip_count").desc(), "zone_name", "borough")
        .limit(ZONE_TABLE_ROWS)
    )


def demand_heatmap(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy("weekday_name", "weekday_number", "pickup_hour")
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy("weekday_number", "pickup_hour")
    )


def demand_heatmap_chart(hourly: DataFrame) -> DataFrame:
    """The chart's own grain: hour across, week day name down."""
    return hourly.groupBy("pickup_hour", "weekday_name").agg(F.sum("trip_count").alias("trips"))


def _mean_of_days(column: str) -> Column:
    """Plain mean of a two-digit measure, summed exactly, to four places."""
    return settled(f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE) / count({column})", 4)


def kpi_totals(daily: DataFrame) -> DataFrame:
    """Card totals; the two means weigh every day the same."""
    return daily.agg(
        F.sum("trip_count").alias("trips"),
        F.sum("revenue_amount").alias("revenue"),
        _mean_of_days("average_fare_amount").alias("average_fare"),
        _mean_of_days("tip_rate_pct").alias("tip_rate_pct"),
    )


def kpi_rejection_rate(audit: DataFrame) -> DataFrame:
    return audit.agg(
        (100.0 * F.sum("rejected_rows") / F.nullif(F.sum("bronze_rows"), F.lit(0))).alias("rejected_pct")
    )


def quality_panel(audit: DataFrame) -> DataFrame:
    """Successful runs, latest first."""
    return (
        audit.where(F.col("status") == "success")
        .select(
            "dataset_month",
            "bronze_rows",
            "silver_rows",
            "rejected_rows",
            round_half_away("100D * rejected_rows / nullif(bronze_rows, 0)", 4).alias(
                "rejected_rate_pct"
            ),
            "completed_at",
        )
        .orderBy(F.col("completed_at").desc())
    )
