"""Trips and revenue per minute and pickup zone, kept up to date over an event stream.

Messages carry JSON in a ``value`` column, so a file source and a Kafka source
are interchangeable. The event time is the naive local wall clock of the event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmill.sources.lake import exists, materialize, read_table, replace_partitions
from tripmill.sources.replay import parse_events

MINUTE = "1 minute"
KEYS = ("event_minute", "pickup_zone_id")


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of text files, one JSON event per line, oldest file first."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int | None = None
) -> DataFrame:
    """Stream of a topic from its earliest offset; needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def countable(messages: DataFrame) -> DataFrame:
    return parse_events(messages).where(F.col("reject_reason").isNull())


def rejects(messages: DataFrame) -> DataFrame:
    """Events that cannot be counted, with the reason; they do not stop the stream."""
    return parse_events(messages).where(F.col("reject_reason").isNotNull())


def minute_zone(messages: DataFrame, watermark: str | None = None) -> DataFrame:
    """The aggregate itself, for a static or a streaming frame.

    Without a watermark every late event still counts and state only grows. A
    watermark bounds the state, and events later than its delay are dropped.
    """
    events = countable(messages)
    if watermark:
        events = events.withWatermark("event_time", watermark)
    return (
        events.groupBy(F.window("event_time", MINUTE).alias("minute"), "pickup_zone_id")
        .agg(F.count("*").alias("trip_count"), F.sum("amount").alias("revenue_amount"))
        .select(
            F.col("minute.start").alias("event_minute"),
            "pickup_zone_id",
            "trip_count",
            "revenue_amount",
        )
    )


def _start(writer, checkpoint: str, state_partitions: int | None, spark: SparkSession) -> StreamingQuery:
    """Start; a stateful stream keeps its number of state partitions for the life of its checkpoint."""
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if state_partitions is None:
        return writer.start()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _first(messages: DataFrame, checkpoint: str, max_events: int) -> DataFrame:
    """A stream of the first messages only, copied beside the checkpoint."""
    spark, bounded = messages.sparkSession, f"{checkpoint}/bounded"
    copy = (
        messages.select(F.col("value").cast("string"))
        .limit(max_events)
        .writeStream.outputMode("append")
        .format("text")
        .option("path", f"{bounded}/messages")
    )
    _start(copy, f"{bounded}/progress", None, spark).awaitTermination()
    return file_messages(spark, f"{bounded}/messages")


def start_minute_zone(
    messages: DataFrame,
    output: str,
    checkpoint: str,
    state_partitions: int,
    watermark: str | None = None,
    max_events: int | None = None,
    position: Column | None = None,
) -> StreamingQuery:
    """Process everything available now, or the first ``max_events`` messages, and stop.

    ``position`` is a message's number in its stream, from 0 (a replay sends it along, a topic of one partition has
    its offset); the first messages are then the same however they arrive. Without it, arrival decides.

    Each micro-batch takes the new value of every key it touched into the event
    days it belongs to, and rewrites those days only. A batch repeated after a
    failure writes the same values again, so no event is counted twice or lost,
    and the table holds each key once however many batches there were.
    """
    spark = messages.sparkSession
    if max_events is not None and position is not None:
        messages = messages.where(position < max_events)
    elif max_events is not None:
        messages = _first(messages, checkpoint, max_events)

    def upsert(changed: DataFrame, batch_id: int) -> None:
        merge_minutes(changed.withColumns({"updated_at": F.current_timestamp(), "batch_id": F.lit(batch_id)}), output)

    writer = minute_zone(messages, watermark).writeStream.outputMode("update").foreachBatch(upsert)
    return _start(writer, f"{checkpoint}/counts", state_partitions, spark)


def merge_minutes(changed: DataFrame, output: str) -> None:
    """Replace the values of changed keys in the stored table, day by day.

    The merged days are written beside the table first: a partition cannot be
    read and overwritten at once, and a failure between leaves the old days.
    """
    spark = changed.sparkSession
    fresh = materialize(changed.withColumn("event_day", F.date_format("event_minute", "yyyy-MM-dd")), "changed")
    merged = fresh
    if exists(spark, output):
        stored = read_table(spark, output, fresh.schema)
        days = fresh.select("event_day").distinct()
        kept = stored.join(days, "event_day", "left_semi").join(fresh.select(*KEYS), [*KEYS], "left_anti")
        merged = materialize(kept.select(fresh.columns).unionByName(fresh), "merged")
    replace_partitions(merged, output, ["event_day"])


def start_rejects(messages: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append rejected events to a file sink, exactly once."""
    writer = (
        rejects(messages)
        .select("value", "reject_reason")
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", output)
    )
    return _start(writer, checkpoint, None, messages.sparkSession)


def read_minute_zone(spark: SparkSession, output: str) -> DataFrame:
    """Current value of every key."""
    return read_table(spark, output).drop("batch_id", "event_day")
