"""The incremental trip fact: the last loaded month owns a trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions import derived_id
from tripmill.operators.silver import IDENTITY_SORT
from tripmill.operators.sketches import pickup_day


def latest_load_wins(accepted_events: DataFrame) -> DataFrame:
    """Fact state after loading every month of the input in ascending order.

    Each month holds a trip at most once, so per trip the row of the greatest
    month survives. Rank 1 is kept before the shuffle as well as after it. The
    digest does not travel: survivors get theirs from the identity columns.
    """
    ranked = Window.partitionBy(*IDENTITY_SORT).orderBy(F.col("dataset_month").desc())
    digest = derived_id(accepted_events.columns)
    return (
        accepted_events.drop(*digest)
        .withColumn("load_rank", F.row_number().over(ranked))
        .where("load_rank = 1")
        .withColumns(digest)
        .select(*accepted_events.columns)
    )


def latest_of_shared_hours(accepted_events: DataFrame) -> DataFrame:
    """The same rows as ``latest_load_wins``, with a shuffle of the contested hours only.

    The identity covers the pickup instant, so a trip can only occur twice in an
    hour that several months hold. Those hours are found by a small aggregate
    (calendar sized, so it is sent to all tasks); rows of all other hours pass
    without a shuffle. The input is read three times, so it should be a stored table.
    """
    hour = F.coalesce(F.date_trunc("hour", "pickup_at"), F.lit("0001-01-01").cast("timestamp"))
    timed = accepted_events.withColumn("trip_hour", hour)
    shared = (
        timed.groupBy("trip_hour")
        .agg(F.min("dataset_month").alias("first_month"), F.max("dataset_month").alias("last_month"))
        .where("first_month < last_month")
        .select("trip_hour")
    )
    shared = F.broadcast(shared)
    alone = timed.join(shared, "trip_hour", "left_anti").drop("trip_hour")
    meeting = timed.join(shared, "trip_hour", "left_semi").drop("trip_hour")
    return alone.unionByName(latest_load_wins(meeting))


def merge_loads(fact: DataFrame, new: DataFrame, months: Sequence[str]) -> DataFrame:
    """Delete-and-insert by trip id.

    Rows of the loaded months go, rows of other months go when a new row has
    their id, and the new rows enter. ``new`` holds a trip at most once.

    The id covers the pickup instant, so only rows of the new rows' pickup days
    are compared by id; the days are calendar sized and sent to all tasks, and
    rows of all other days pass without a shuffle.
    """
    others = fact.where(~F.col("dataset_month").isin(*months)).withColumn("trip_day", pickup_day())
    days = F.broadcast(new.select(pickup_day().alias("trip_day")).distinct())
    alone = others.join(days, "trip_day", "left_anti")
    meeting = others.join(days, "trip_day", "left_semi").join(new.select("trip_id"), "trip_id", "left_anti")
    kept = alone.unionByName(meeting.select(alone.columns))
    return sync_columns(kept, new).unionByName(new)


def sync_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows in the new column set: new columns are NULL, dropped ones disappear."""
    present = set(old.columns)
    return old.select(
        *(
            F.col(field.name).cast(field.dataType).alias(field.name)
            if field.name in present
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in new.schema
        )
    )


def contested_months(fact: DataFrame, new: DataFrame, months: Sequence[str]) -> DataFrame:
    """Months outside the load that hold a trip the load now owns.

    The id covers the pickup instant, so only fact rows inside the load's pickup
    span can clash; the two bounds reach the Parquet scan as range filters.
    """
    low, high = new.agg(F.min("pickup_at"), F.max("pickup_at")).first()
    candidates = fact.where(~F.col("dataset_month").isin(*months))
    if low is not None:
        candidates = candidates.where(F.col("pickup_at").between(F.lit(low), F.lit(high)))
    return (
        candidates.select("dataset_month", "trip_id")
        .join(new.select("trip_id"), "trip_id", "left_semi")
        .select("dataset_month")
        .distinct()
    )
