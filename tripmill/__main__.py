"""Command line: ``python -m tripmill <command> ...`` (run it with spark-submit on a cluster)."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tripmill.operators import maintenance, marts
from tripmill.plans import monthly
from tripmill.session import build_session
from tripmill.sources import bronze, replay, snapshots
from tripmill.streaming import minute_zone as stream


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    """Check a month's trip file and lay it into bronze, with the zone lookup if given."""
    raw = spark.read.parquet(args.source)
    bronze.require_contract(raw)
    bronze.write_bronze(
        raw.withColumn("file_month", F.lit(args.month)), monthly.trips_path(args.root)
    )
    if args.zones:
        bronze.read_zones(spark, args.zones).write.mode("overwrite").csv(
            monthly.zones_path(args.root), header=True
        )


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    monthly.load_months(spark, args.root, [args.month], args.run_id).show(truncate=False)


def backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    coverage = monthly.backfill(spark, args.root, args.start, args.end, args.run_id)
    coverage.where("NOT available").show(truncate=False)


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    monthly.export_month(spark, args.root, args.output, args.month).show(truncate=False)


def clean(spark: SparkSession, args: argparse.Namespace) -> None:
    monthly.clean_boundaries(spark, args.root).show(truncate=False)


def validate(spark: SparkSession, args: argparse.Namespace) -> None:
    fact = monthly.stored(spark, args.root, monthly.FACT)
    daily = monthly.stored_gold(spark, args.root, "mart_daily_demand")
    row = maintenance.year_validation(fact, daily, args.year).first()
    print(row.asDict())
    if not row.valid:
        raise SystemExit("the year's facts are not valid")


def inspect(spark: SparkSession, args: argparse.Namespace) -> None:
    fact = monthly.stored(spark, args.root, monthly.FACT, version=args.version)
    maintenance.warehouse_inspect(fact).orderBy("dataset_month").show(1000, truncate=False)
    sizes = snapshots.table_sizes(spark, args.root, args.version)
    sizes.groupBy("table_name").agg(*(F.sum(c).alias(c) for c in ("rows", "files", "bytes"))).show(truncate=False)


def versions(spark: SparkSession, args: argparse.Namespace) -> None:
    print(snapshots.versions(spark, args.root))


def expire(spark: SparkSession, args: argparse.Namespace) -> None:
    print(snapshots.expire(spark, args.root, args.keep))


def verify(spark: SparkSession, args: argparse.Namespace) -> None:
    faults = snapshots.damaged(spark, args.root, args.version)
    faults.show(1000, truncate=False)
    if not faults.isEmpty():
        raise SystemExit("files of this version are not as they were written")


def summary(spark: SparkSession, args: argparse.Namespace) -> None:
    daily = marts.daily_summary_local(spark.read.parquet(args.source))
    daily.write.mode("overwrite").parquet(args.output)


def replay_trips(spark: SparkSession, args: argparse.Namespace) -> None:
    trips = spark.read.parquet(args.source)
    if args.limit is not None:
        trips = replay.first_events(trips, "tpep_pickup_datetime", args.limit)
    replay.to_events(trips).write.mode("append").text(args.output)


def minutes(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.servers:
        messages = stream.kafka_messages(spark, args.servers, args.source)
    else:
        messages = stream.file_messages(spark, args.source)
    rejected = stream.start_rejects(
        messages, f"{args.output}/rejects", f"{args.checkpoint}/rejects"
    )
    counted = stream.start_minute_zone(
        messages,
        f"{args.output}/minutes",
        f"{args.checkpoint}/minutes",
        args.state_partitions,
        args.watermark,
        args.max_events,
    )
    counted.awaitTermination()
    rejected.awaitTermination()


COMMANDS = {
    "land": (land, {"--root": {}, "--source": {}, "--month": {}, "--zones": {"required": False}}),
    "load": (load, {"--root": {}, "--month": {}}),
    "backfill": (backfill, {"--root": {}, "--start": {}, "--end": {}}),
    "export": (export, {"--root": {}, "--month": {}, "--output": {}}),
    "clean": (clean, {"--root": {}}),
    "validate": (validate, {"--root": {}, "--year": {"type": int}}),
    "inspect": (inspect, {"--root": {}, "--version": {"type": int, "required": False}}),
    "versions": (versions, {"--root": {}}),
    "expire": (expire, {"--root": {}, "--keep": {"type": int}}),
    "verify": (verify, {"--root": {}, "--version": {"type": int, "required": False}}),
    "summary": (summary, {"--source": {}, "--output": {}}),
    "replay": (
        replay_trips,
        {
            "--source": {},
            "--output": {},
            "--limit": {"type": int, "required": False},
        },
    ),
    "minutes": (
        minutes,
        {
            "--source": {},
            "--output": {},
            "--checkpoint": {},
            "--servers": {"required": False},
            "--state-partitions": {"type": int},
            "--watermark": {"required": False},
            "--max-events": {"type": int, "required": False},
        },
    ),
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripmill")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (_, options) in COMMANDS.items():
        command = commands.add_parser(name)
        for flag, settings in options.items():
            command.add_argument(flag, **{"required": True, **settings})
        if name in ("load", "backfill"):
            command.add_argument("--run-id", default=uuid.uuid4().hex)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(f"tripmill-{args.command}")
    COMMANDS[args.command][0](spark, args)


if __name__ == "__main__":
    main()
