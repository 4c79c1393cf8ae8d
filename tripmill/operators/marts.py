"""Gold marts and the month guard in front of them.

Every mart is one shuffle of partial aggregates: grouping keys are a date, a
zone or a week hour, so a hot key shrinks to one row per task before it moves.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions import (
    exact_mean,
    exact_sum,
    in_own_month,
    mean_decimal,
    mean_minutes,
    share_pct,
    weekday_name,
    weekday_number,
)


def month_bounds(dataset_month: str) -> tuple[date, date]:
    """First day of the month and of the next one."""
    year, month = (int(part) for part in dataset_month.split("-"))
    return date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)


def guarded(fact: DataFrame, *months: str) -> DataFrame:
    """Facts whose UTC pickup month is their file month, of all or the given months.

    Given months are a partition filter plus a pickup range, and both reach the
    scan. Trips picked up in the last local hours of a month belong to the next
    UTC month and are in neither month's marts.
    """
    inside = fact.where(in_own_month("pickup_at", "dataset_month"))
    if not months:
        return inside
    start, end = month_bounds(min(months))[0], month_bounds(max(months))[1]
    return inside.where(
        F.col("dataset_month").isin(*months)
        & (F.col("pickup_at") >= F.lit(start).cast("timestamp"))
        & (F.col("pickup_at") < F.lit(end).cast("timestamp"))
    )


def mart_daily_demand(facts: DataFrame) -> DataFrame:
    return facts.groupBy(F.to_date("pickup_at").alias("trip_date")).agg(
        F.count("*").alias("trip_count"),
        F.expr("sum(coalesce(passenger_count, 0))").alias("passenger_count"),
        exact_sum("trip_distance_miles", 2).alias("distance_miles"),
        F.sum("total_amount").alias("revenue_amount"),
        mean_decimal("fare_amount").alias("average_fare_amount"),
        mean_minutes("duration_minutes").alias("average_duration_minutes"),
        share_pct("tip_amount > 0").alias("tip_rate_pct"),
    )


def mart_zone_performance(facts: DataFrame, zones: DataFrame) -> DataFrame:
    """Aggregate by day and zone first; names are attached to the small result.

    A zone id listed more than once under one name multiplies its facts in the
    join this stands for, hence the ``listings`` factor.
    """
    by_zone = facts.groupBy(
        F.to_date("pickup_at").alias("trip_date"), F.col("pickup_zone_id").alias("zone_id")
    ).agg(
        F.count("*").alias("trip_count"),
        F.sum("total_amount").alias("revenue_amount"),
        mean_decimal("fare_amount").alias("average_fare_amount"),
        mean_minutes("duration_minutes").alias("average_duration_minutes"),
        exact_mean("average_speed_mph", 2).alias("average_speed_mph"),
    )
    names = zones.groupBy("zone_id", "borough", "zone_name").agg(F.count("*").alias("listings"))
    listings = F.coalesce("listings", F.lit(1))
    return by_zone.join(names, "zone_id", "left").select(
        "trip_date",
        "zone_id",
        "borough",
        "zone_name",
        (F.col("trip_count") * listings).alias("trip_count"),
        (F.col("revenue_amount") * listings).cast("decimal(28,2)").alias("revenue_amount"),
        "average_fare_amount",
        "average_duration_minutes",
        "average_speed_mph",
    )


def mart_hourly_pattern(guarded_facts: DataFrame) -> DataFrame:
    """Week day and hour pattern; the guard makes the file month the pickup month."""
    return (
        guarded_facts.groupBy(
            "dataset_month",
            weekday_number("pickup_at").alias("weekday_number"),
            F.hour("pickup_at").alias("pickup_hour"),
        )
        .agg(
            F.count("*").alias("trip_count"),
            mean_decimal("fare_amount").alias("average_fare_amount"),
            mean_minutes("duration_minutes").alias("average_duration_minutes"),
            share_pct("tip_amount > 0").alias("tip_rate_pct"),
        )
        .select(
            "dataset_month",
            weekday_name("weekday_number").alias("weekday_name"),
            "weekday_number",
            "pickup_hour",
            "trip_count",
            "average_fare_amount",
            "average_duration_minutes",
            "tip_rate_pct",
        )
    )


def daily_summary_local(raw: DataFrame) -> DataFrame:
    """Raw trips by local date, no quality filter."""
    return (
        raw.groupBy(F.to_date("tpep_pickup_datetime").alias("trip_date"))
        .agg(
            F.count("*").alias("trip_count"),
            exact_sum("total_amount", 2).alias("revenue_amount"),
            exact_mean("trip_distance", 2).alias("average_distance_miles"),
        )
        .orderBy("trip_date")
    )


def month_guard_report(facts: DataFrame) -> DataFrame:
    """Per file month: facts, facts the marts see, facts lost at the month boundary."""
    inside = in_own_month("pickup_at", "dataset_month")
    return facts.groupBy("dataset_month").agg(
        F.count("*").alias("fact_rows"),
        F.count_if(inside).alias("guarded_rows"),
        F.count_if(~inside).alias("boundary_rows"),
    )
