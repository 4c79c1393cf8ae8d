"""Replay of trips as JSON events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.sources.lake import materialize

# The columns of a replayed event.
EVENT_TYPES = {
    "tpep_pickup_datetime": "string",
    "PULocationID": "double",
    "passenger_count": "double",
    "trip_distance": "double",
    "total_amount": "double",
}
EVENT_COLUMNS = tuple(EVENT_TYPES)
# The field of a message that says which one of its replay it is, from 0.
POSITION = "position"
# How monotonically_increasing_id puts a row's task and its place in the task together.
TASK_SHIFT = 33
LEAST_ZONE, MOST_ZONE = -(1 << 31), (1 << 31) - 1


def wall_text(moment: Column) -> Column:
    """``2024-01-01 00:00:07`` and, only when not zero, six fraction digits."""
    whole = F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
    fraction = F.date_format(moment, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))


def first_events(trips: DataFrame, order: str, limit: int) -> DataFrame:
    """The first ``limit`` trips in replay order (each task keeps its own first ones)."""
    return trips.orderBy(order).limit(limit)


def numbered(trips: DataFrame, order: str) -> DataFrame:
    """The trips with their position in replay order.

    Files of parallel tasks arrive in any order and are read in pieces, so the order has to travel in the messages.
    A task numbers its own range of the sorted trips; the ranges before it are added from a row per task.
    """
    placed = materialize(trips.orderBy(order).withColumn("place", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("place", TASK_SHIFT).alias("task")
    sizes = placed.groupBy(task).agg(F.count("*").alias("rows"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = F.col("place").bitwiseAND((1 << TASK_SHIFT) - 1)
    return (
        placed.withColumn("task", task)
        .join(F.broadcast(starts), "task")
        .withColumn(POSITION, F.col("start") + inside)
        .drop("task", "start", "place")
    )


def position() -> Column:
    """The position a message was sent with; NULL if it has none."""
    return F.get_json_object(F.col("value").cast("string"), f"$.{POSITION}").try_cast("long")


def to_events(trips: DataFrame) -> DataFrame:
    """One JSON document per trip in the column ``value``, with its position if the trips are numbered."""
    columns = [
        wall_text(F.col(name)).alias(name) if name == "tpep_pickup_datetime" else F.col(name)
        for name in (*EVENT_COLUMNS, *(name for name in trips.columns if name == POSITION))
    ]
    return trips.select(F.to_json(F.struct(*columns)).alias("value"))


def parse_events(messages: DataFrame) -> DataFrame:
    """Events of a frame (static or streaming) that carries JSON in ``value``.

    Adds the event time, the whole zone id and, for an event that cannot be
    counted, why; the raw message stays for the reject output. Fields are taken
    as text first, so quoted numbers count and no value can stop a stream.
    """
    as_text = ", ".join(f"{name} string" for name in EVENT_COLUMNS)
    message = F.col("value").cast("string")
    parsed = messages.select(
        message.alias("value"), F.from_json(message, as_text).alias("event")
    ).select("value", "event.*")
    zone = F.expr("try_cast(PULocationID AS DOUBLE)")
    read = parsed.withColumns(
        {
            "event_time": F.try_to_timestamp("tpep_pickup_datetime"),
            # Fractions are cut off; NaN is beyond every bound.
            "pickup_zone_id": F.when(
                (zone >= LEAST_ZONE) & (zone <= MOST_ZONE), zone.try_cast("int")
            ),
            # From decimal text, so that sums do not depend on order.
            "amount": F.expr("try_cast(total_amount AS DECIMAL(28, 8))"),
        }
    )
    reason = (
        F.when(F.col("event_time").isNull(), "unreadable_timestamp")
        .when(F.col("PULocationID").isNull(), "missing_zone")
        .when(F.col("pickup_zone_id").isNull(), "unreadable_zone")
        .when(F.col("total_amount").isNull(), "missing_amount")
        .when(F.col("amount").isNull(), "unreadable_amount")
    )
    typed = {name: F.col(name).try_cast(kind) for name, kind in EVENT_TYPES.items()}
    return read.withColumn("reject_reason", reason).withColumns(typed)
