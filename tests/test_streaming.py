import itertools
import json
import os

from pyspark.sql import functions as F

from tripmill.sources import replay
from tripmill.streaming import minute_zone as stream


def event(minute="2024-01-01 10:00", second="07.5", zone=1, amount=2.5):
    return json.dumps(
        {
            "tpep_pickup_datetime": minute and f"{minute}:{second}",
            "PULocationID": zone,
            "passenger_count": 1.0,
            "trip_distance": 1.0,
            "total_amount": amount,
        }
    )


_arrival = itertools.count(1_700_000_000)


def land(folder, name, *events):
    """Files are taken in order of their modification time, so each gets its own second."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(events) + "\n")
    moment = next(_arrival)
    os.utime(folder / name, (moment, moment))


def current(spark, output):
    rows = stream.read_minute_zone(spark, output).collect()
    return sorted((str(r.event_minute)[11:16], r.pickup_zone_id, r.trip_count, float(r.revenue_amount)) for r in rows)


def test_restart_from_checkpoint_counts_once(spark, tmp_path):
    source, output, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    land(source, "1.json", event(), event(second="59.9", amount=1.25), event(zone=2))

    def run():
        messages = stream.file_messages(spark, str(source), 1)
        stream.start_minute_zone(messages, output, checkpoint, state_partitions=2).awaitTermination()
        return current(spark, output)

    assert run() == [("10:00", 1, 2, 3.75), ("10:00", 2, 1, 2.5)]
    assert run() == [("10:00", 1, 2, 3.75), ("10:00", 2, 1, 2.5)]
    # A late event for an old minute and a new minute arrive after the restart.
    land(source, "2.json", event(amount=0.1), event("2024-01-01 10:01"))
    assert run() == [("10:00", 1, 3, 3.85), ("10:00", 2, 1, 2.5), ("10:01", 1, 1, 2.5)]


def test_watermark_drops_only_what_is_later_than_its_delay(spark, tmp_path):
    source = tmp_path / "in"
    land(source, "1.json", event("2024-01-01 10:00"))
    land(source, "2.json", event("2024-01-01 12:00"))
    # A new watermark drops rows from the batch after the next one on.
    land(source, "3.json", event("2024-01-01 12:01"))
    land(source, "4.json", event("2024-01-01 10:00"))

    def run(delay):
        name = delay.replace(" ", "")
        output, checkpoint = str(tmp_path / f"out{name}"), str(tmp_path / f"cp{name}")
        messages = stream.file_messages(spark, str(source), 1)
        stream.start_minute_zone(messages, output, checkpoint, 2, delay).awaitTermination()
        return sum(row[2] for row in current(spark, output))

    assert run("1 day") == 4
    assert run("10 minutes") == 3


def test_bad_events_are_set_aside_with_a_reason(spark, tmp_path):
    source = tmp_path / "in"
    land(source, "1.json", event(), event(zone=None), event(amount=None), event(minute=None), "not json", event("2024-13-99 10:00"))
    messages = stream.file_messages(spark, str(source))
    output = str(tmp_path / "rejects")
    stream.start_rejects(messages, output, str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(output).groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in rows} == {
        "missing_zone": 1,
        "missing_amount": 1,
        "unreadable_timestamp": 3,
    }
    stream.start_minute_zone(messages, str(tmp_path / "out"), str(tmp_path / "cp2"), state_partitions=2).awaitTermination()
    assert current(spark, str(tmp_path / "out")) == [("10:00", 1, 1, 2.5)]


def test_no_value_stops_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    wild = [event(zone=z) for z in (1e12, float("nan"), "x", 1.5, "2")]
    wild += [event(amount=a) for a in (1e25, float("nan"), "12.5", "much")] + ["garbage", "{}", '{"PULocationID": [1]}']
    land(source, "1.json", *wild, event())
    messages = stream.file_messages(spark, str(source))
    stream.start_rejects(messages, str(tmp_path / "rejects"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "rejects")).groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in rows} == {
        "unreadable_zone": 3,
        "unreadable_amount": 3,
        "unreadable_timestamp": 3,
    }
    stream.start_minute_zone(messages, str(tmp_path / "out"), str(tmp_path / "cp2"), state_partitions=2).awaitTermination()
    assert current(spark, str(tmp_path / "out")) == [("10:00", 1, 3, 17.5), ("10:00", 2, 1, 2.5)]


def test_many_batches_leave_one_version_of_a_key(spark, tmp_path):
    source, output = tmp_path / "in", str(tmp_path / "out")
    for n in range(20):
        land(source, f"{n:02d}.json", event(amount=1.0), event(f"2024-01-{n + 1:02d} 11:00"))
    messages = stream.file_messages(spark, str(source), 1)
    stream.start_minute_zone(messages, output, str(tmp_path / "cp"), state_partitions=1).awaitTermination()
    rows = spark.read.parquet(output)
    assert rows.count() == rows.select(*stream.KEYS).distinct().count() == 21
    assert ("10:00", 1, 20, 20.0) in current(spark, output)


def test_a_bounded_stream_takes_the_first_events(spark, tmp_path):
    source = tmp_path / "in"
    land(source, "1.json", event(zone=1), event(zone=2), event(zone=3))
    land(source, "2.json", event(zone=4))
    messages = stream.file_messages(spark, str(source), 1)
    stream.start_minute_zone(
        messages, str(tmp_path / "out"), str(tmp_path / "cp"), state_partitions=1, max_events=2
    ).awaitTermination()
    assert [row[1] for row in current(spark, str(tmp_path / "out"))] == [1, 2]


def test_numbered_events_are_bounded_by_position_however_they_arrive(spark, tmp_path):
    trips = spark.range(400, numPartitions=4).select(
        (F.lit(1000) - 2 * F.col("id")).alias("event_id"),
        F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.col("id").cast("int").alias("PULocationID"),
        *(F.lit(1.0).alias(name) for name in ("passenger_count", "trip_distance", "total_amount")),
    )
    numbered = replay.numbered(trips, "event_id")
    placed = sorted((r.position, r.event_id) for r in numbered.select("position", "event_id").collect())
    assert placed == [(n, 202 + 2 * n) for n in range(400)]
    # The last events arrive first, in many files.
    source = str(tmp_path / "in")
    replay.to_events(numbered.orderBy(F.desc("position"))).write.option("maxRecordsPerFile", 30).text(source)
    land(tmp_path / "in", "rest.txt", event(zone=1), "not json", '{"position": "x"}')
    stream.start_minute_zone(
        stream.file_messages(spark, source, 2), str(tmp_path / "out"), str(tmp_path / "cp"), state_partitions=2,
        max_events=37, position=replay.position(),
    ).awaitTermination()
    assert [row[1] for row in current(spark, str(tmp_path / "out"))] == list(range(399 - 36, 400))


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(500).select(
        F.timestamp_add("SECOND", (F.col("id") * 37) % 600, F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")).alias("tpep_pickup_datetime"),
        (F.col("id") % 7).cast("int").alias("PULocationID"),
        F.lit(1.0).alias("passenger_count"),
        F.lit(1.0).alias("trip_distance"),
        (F.col("id") / 10).alias("total_amount"),
    )
    source = str(tmp_path / "in")
    replay.to_events(rows).repartition(5).write.text(source)
    stream.start_minute_zone(
        stream.file_messages(spark, source, 1), str(tmp_path / "out"), str(tmp_path / "cp"), state_partitions=3
    ).awaitTermination()
    batch = stream.minute_zone(spark.read.text(source)).collect()
    expected = sorted(
        (str(r.event_minute)[11:16], r.pickup_zone_id, r.trip_count, float(r.revenue_amount)) for r in batch
    )
    assert current(spark, str(tmp_path / "out")) == expected


def test_event_text_and_limit(spark):
    rows = spark.sql(
        """SELECT t AS tpep_pickup_datetime, 1 AS PULocationID, 1D AS passenger_count, 1D AS trip_distance,
                  2D AS total_amount, i AS event_id
           FROM VALUES (3, TIMESTAMP_NTZ '2024-01-01 00:00:07.12'), (1, TIMESTAMP_NTZ '2024-01-01 00:00:07'),
                       (2, NULL) AS v(i, t)"""
    )
    first = replay.to_events(replay.first_events(rows, "event_id", 2)).collect()
    assert len(first) == 2
    texts = [json.loads(r.value).get("tpep_pickup_datetime") for r in replay.to_events(rows.orderBy("event_id")).collect()]
    assert texts == ["2024-01-01 00:00:07", None, "2024-01-01 00:00:07.120000"]
