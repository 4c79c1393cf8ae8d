"""Declarative data tests. Each yields rows (model, column_name, check_name, severity, failures)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.operators.silver import ACCEPTED, QUALITY_STATUSES

MAX_REJECTED_SHARE = 0.05

# Which columns of which model are tested for what.
NOT_NULL = {
    "stg_trips": ("pickup_at", "dropoff_at"),
    "dim_zone": ("zone_id", "zone_name"),
    "silver_trip_events": ("trip_id",),
    "silver_trips": ("trip_id",),
    "fact_trips": ("trip_id", "dataset_month"),
    "mart_daily_demand": ("trip_date", "trip_count"),
    "mart_zone_performance": ("trip_date", "zone_id"),
    "mart_hourly_pattern": ("pickup_hour",),
}
UNIQUE = {
    "dim_zone": "zone_id",
    "silver_trip_events": "trip_id",
    "silver_trips": "trip_id",
    "fact_trips": "trip_id",
    "mart_daily_demand": "trip_date",
}
GRAINS = {
    "mart_zone_performance": ("trip_date", "zone_id"),
    "mart_hourly_pattern": ("dataset_month", "weekday_number", "pickup_hour"),
}
# A missing timestamp has a quality status of its own, so staging only warns about it.
WARN_ONLY = ("stg_trips",)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _severity(model: str) -> str:
    return "warn" if model in WARN_ONLY else "error"


def _result(model: str, column: str | Column, check: str, failures: Column) -> list[Column]:
    return [
        F.lit(model).alias("model"),
        (F.lit(column) if isinstance(column, str) else column).alias("column_name"),
        F.lit(check).alias("check_name"),
        F.lit(_severity(model)).alias("severity"),
        failures.alias("failures"),
    ]


def _results(counted: DataFrame, check: str, rows: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One result per (model, column, failures) from a single counted row."""
    found = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.lit(check).alias("check_name"),
            F.lit(_severity(model)).alias("severity"),
            failures.alias("failures"),
        )
        for model, column, failures in rows
    ]
    return counted.select(F.inline(F.array(*found)))


def _by_relation(models: Mapping[str, DataFrame], names: Iterable[str]) -> list[tuple[DataFrame, list[str]]]:
    """Models put together by what they read: a view and its table are one relation."""
    shared: dict[int, tuple[DataFrame, list[str]]] = {}
    for name in names:
        shared.setdefault(id(models[name]), (models[name], []))[1].append(name)
    return list(shared.values())


def not_null(specs: Mapping[str, Sequence[str]], df: DataFrame) -> DataFrame:
    """All columns of all models over one relation in a single pass."""
    columns = sorted({column for own in specs.values() for column in own})
    counted = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return _results(counted, "not_null", [(m, c, F.col(c)) for m, own in specs.items() for c in own])


def unique(specs: Mapping[str, str], df: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Keys that occur more than once; NULL keys are not compared. Models of one key share its grouping.

    ``scope`` names the build a key belongs to when several builds share a frame.
    """
    reports = []
    for column in sorted(set(specs.values())):
        repeated = (
            df.where(F.col(column).isNotNull())
            .groupBy(*scope, column)
            .agg(F.count("*").alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("failures"))
        )
        own = [(model, column, F.col("failures")) for model, key in specs.items() if key == column]
        reports.append(_results(repeated, "unique", own))
    return _union(reports)


def accepted_values(model: str, df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the list."""
    strange = (
        df.groupBy(column)
        .agg(F.count("*").alias("n"))
        .where(~F.col(column).isin(*values))
        .agg(F.count("*").alias("failures"))
    )
    return strange.select(*_result(model, column, "accepted_values", F.col("failures")))


def relationships(
    model: str, child: DataFrame, columns: Sequence[str], parent: DataFrame, field: str
) -> DataFrame:
    """Child rows whose key has no parent, for all key columns in one pass; NULL keys are ignored.

    Keys are counted before the join, so a hot key is one row when it meets its parent.
    """
    pairs = F.explode(
        F.array(
            *(F.struct(F.lit(name).alias("key_column"), F.col(name).alias("key")) for name in columns)
        )
    )
    keys = (
        child.select(pairs.alias("pair"))
        .select("pair.*")
        .groupBy("key_column", "key")
        .agg(F.count("*").alias("n"))
    )
    known = parent.select(F.col(field).alias("key")).distinct().withColumn("known", F.lit(True))
    orphan = F.col("key").isNotNull() & F.col("known").isNull()
    counted = (
        keys.join(known, "key", "left")
        .groupBy("key_column")
        .agg(F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("failures"))
    )
    return counted.select(*_result(model, F.col("key_column"), "relationships", F.col("failures")))


def check_not_null(models: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [not_null({m: NOT_NULL[m] for m in names}, df) for df, names in _by_relation(models, NOT_NULL)]
    )


def check_unique(models: Mapping[str, DataFrame]) -> DataFrame:
    """``silver_trip_events`` holds one build per month, so its ids are unique per month."""
    return _union(
        [
            unique(
                {m: UNIQUE[m] for m in names},
                df,
                scope=("dataset_month",) if "silver_trip_events" in names else (),
            )
            for df, names in _by_relation(models, UNIQUE)
        ]
    )


def check_accepted_values(events: DataFrame) -> DataFrame:
    return accepted_values("silver_trip_events", events, "quality_status", QUALITY_STATUSES)


def check_relationships(fact: DataFrame, zones: DataFrame) -> DataFrame:
    return relationships(
        "fact_trips", fact, ("pickup_zone_id", "dropoff_zone_id"), zones, "zone_id"
    )


def check_gold_grains(models: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated grains per mart; one row per mart, zero when the grain holds."""
    repeated = [
        models[model]
        .groupBy(*grain)
        .agg(F.count("*").alias("n"))
        .select(F.lit(model).alias("model"), (F.col("n") > 1).alias("repeated"))
        for model, grain in GRAINS.items()
    ]
    return _union(repeated).groupBy("model").agg(F.count_if("repeated").alias("duplicate_grains"))


def quarantine_shares(events: DataFrame) -> DataFrame:
    """Rejected share of each month's deduplicated events."""
    return (
        events.groupBy("dataset_month")
        .agg(
            F.count("*").alias("total_rows"),
            F.count_if(F.col("quality_status") != ACCEPTED).alias("rejected_rows"),
        )
        .withColumn(
            "rejected_share",
            F.col("rejected_rows") / F.greatest(F.col("total_rows"), F.lit(1)),
        )
    )


def check_quarantine_rate(events: DataFrame) -> DataFrame:
    """Months that reject more than the limit."""
    return quarantine_shares(events).where(F.col("rejected_share") > MAX_REJECTED_SHARE)
