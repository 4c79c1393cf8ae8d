"""Named queries over the generated tables, one per capability.

Every query uses the tables whole. Results are handed out in portable types:
dates and instants as text, decimals as doubles, whole numbers as bigint.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import (
    IDENTITY_COLUMNS,
    derived_id,
    instant_text,
    month_text,
    trip_id,
    weekday_name,
    weekday_number,
)
from tripmill.operators import checks, dashboards, facts, maintenance, marts, runs, silver, sketches, staging
from tripmill.plans import monthly, publish
from tripmill.plans.warehouse import Warehouse
from tripmill.session import prepare
from tripmill.sources import adapters, bronze, replay, snapshots
from tripmill.sources.lake import fresh_dir, materialize
from tripmill.streaming import minute_zone as stream

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of queries that take some.
RELOADED_MONTH = "1998-03"
VALIDATED_YEAR = 1998
COVERAGE_RANGE = ("1994-11", "2002-03")
BOUNDED_EVENTS = 2_500
WATERMARK = "40 days"
EVENTS_PER_FILE = 25_000
STATE_PARTITIONS = 8

QUERIES: dict[str, Query] = {}


def _portable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        match field.dataType:
            case T.DateType() | T.TimestampType() | T.TimestampNTZType():
                column = column.cast("string")
            case T.DecimalType() | T.FloatType():
                column = column.cast("double")
            case T.IntegerType() | T.ShortType():
                column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(build: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _portable(build(prepare(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(
        adapters.trips_raw(spark, sf_dir),
        lambda: adapters.zones_raw(spark, sf_dir),
        F.col("file_month"),
    )


# What facts and marts are made of, and the digest where trips are told apart by it.
MEASURES = (
    *IDENTITY_COLUMNS,
    "dataset_month",
    "passenger_count",
    "trip_distance_miles",
    "fare_amount",
    "tip_amount",
    "duration_minutes",
    "average_speed_mph",
    "quality_status",
)
IDENTIFIED = ("trip_id", *MEASURES)


def written_warehouse(spark: SparkSession, sf_dir: str, *columns: str) -> Warehouse:
    """The warehouse with its scored events on storage, for queries that read them often.

    Only the named columns are computed and written, or all of them. The digest is not: readers take it from the
    identity columns.
    """
    built = warehouse(spark, sf_dir)
    events = built.silver_trip_events
    events = events.select(*columns) if columns else events
    digest = derived_id(events.columns)
    stored = materialize(events.drop(*digest), "silver_trip_events")
    built.silver_trip_events = stored.withColumns(digest).select(*events.columns)
    return built


def bronze_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.trips_raw(spark, sf_dir).withColumnRenamed("file_month", "dataset_month")


def audit_table(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Run history with the counts each month's build produced, from scored events if they are at hand."""
    events = warehouse(spark, sf_dir).silver_trip_events if events is None else events
    metrics = runs.run_metrics(bronze_by_month(spark, sf_dir), events)
    return (
        adapters.runs_raw(spark, sf_dir)
        .drop("bronze_rows")
        .join(metrics, "dataset_month")
        .withColumn("details", runs.details_json("run_id", "bronze_rows"))
    )


# ---- sources, staging, silver -------------------------------------------------


@query
def stg_trips(spark, sf_dir):
    return warehouse(spark, sf_dir).stg_trips.drop("transformed_at")


@query
def stg_zones(spark, sf_dir):
    landed = fresh_dir(spark, "zones")
    adapters.zones_raw(spark, sf_dir).write.csv(landed, header=True)
    return staging.stg_zones(bronze.read_zones(spark, landed))


@query
def bronze_contract(spark, sf_dir):
    """Per landed month, from the month's own files."""
    return bronze.contract_report(spark, _landed_bronze(spark, sf_dir)).drop("unreadable")


@query
def bronze_contract_per_file(spark, sf_dir):
    """Months land in a file per vendor; one vendor's file of one month lacks two columns."""
    landed, raw = fresh_dir(spark, "bronze"), adapters.trips_raw(spark, sf_dir)
    second = F.col("VendorID") == 2
    broken = second & (F.col("file_month") == RELOADED_MONTH)
    bronze.write_bronze(raw.where(~second), landed)
    bronze.add_bronze(raw.where(second & ~broken), landed)
    bronze.add_bronze(raw.where(broken).drop("tip_amount", "payment_type"), landed)
    return bronze.contract_report(spark, landed).select("dataset_month", "row_count", "missing_columns", "accepted")


@query
def footer_profile(spark, sf_dir):
    """Counts and bounds per month from footers alone."""
    return bronze.footer_profile(spark, _landed_bronze(spark, sf_dir))


def _landed_bronze(spark, sf_dir):
    landed = fresh_dir(spark, "bronze")
    bronze.write_bronze(adapters.trips_raw(spark, sf_dir), landed)
    return landed


@query
def bronze_partitioned_scan(spark, sf_dir):
    return (
        bronze.read_bronze(spark, _landed_bronze(spark, sf_dir))
        .groupBy("year", "month")
        .agg(
            F.count("*").alias("trips"),
            F.min("tpep_pickup_datetime").alias("first_pickup"),
            F.max("tpep_pickup_datetime").alias("last_pickup"),
        )
    )


def _zone_files(spark, sf_dir):
    """The zone lookup as one sorted text file per borough, so that SQL can rebuild every byte."""
    path = fresh_dir(spark, "zone files")
    line = F.concat_ws(",", "LocationID", "Borough", "Zone", "service_zone")
    lines = F.sort_array(F.collect_list(F.struct(F.col("LocationID").cast("int").alias("id"), line.alias("line"))))
    (
        adapters.zones_raw(spark, sf_dir)
        .groupBy(F.col("Borough").alias("borough"))
        .agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("value"))
        .write.partitionBy("borough")
        .text(path)
    )
    return path


def _by_borough(files):
    borough = F.regexp_extract("file_key", "borough=([^/]+)/", 1)
    return files.select(borough.alias("borough"), "bytes", "sha256")


@query
def file_checksums(spark, sf_dir):
    return _by_borough(bronze.file_facts(spark, _zone_files(spark, sf_dir), "*.txt"))


@query
def changed_files(spark, sf_dir):
    """Against a record that knows an older version of one file and has never seen another."""
    current = bronze.file_facts(spark, _zone_files(spark, sf_dir), "*.txt")
    borough = F.regexp_extract("file_key", "borough=([^/]+)/", 1)
    known = current.where(borough != "EUROPE").withColumn(
        "sha256", F.when(borough == "ASIA", F.sha2("sha256", 256)).otherwise(F.col("sha256"))
    )
    return _by_borough(bronze.changed_files(current, known))


@query
def bronze_manifest(spark, sf_dir):
    """The records of each month's files, put together; names and digests differ from run to run."""
    files = bronze.bronze_manifest(spark, _landed_bronze(spark, sf_dir))
    return files.groupBy("dataset", "dataset_month", "status", "columns").agg(
        F.sum("rows").alias("rows"),
        F.bool_and((F.length("sha256") == 64) & (F.col("bytes") > 0) & F.col("changed")).alias("complete"),
    )


@query
def trip_id_text(spark, sf_dir):
    """Digest and its instants for every staged row, copies included."""
    return warehouse(spark, sf_dir).stg_trips.select(
        trip_id().alias("trip_id"),
        instant_text("pickup_at").alias("pickup_text"),
        instant_text("dropoff_at").alias("dropoff_text"),
    )


QUERIES["trip_id"] = QUERIES.pop("trip_id_text")


@query
def trip_measures(spark, sf_dir):
    measured = silver.with_measures(warehouse(spark, sf_dir).stg_trips)
    return measured.select(
        "dataset_month", "pickup_at", "dropoff_at", "duration_minutes", "average_speed_mph"
    )


@query
def quality_status(spark, sf_dir):
    """Rows per month and status before copies are removed."""
    measured = silver.with_measures(warehouse(spark, sf_dir).stg_trips)
    return (
        measured.groupBy("dataset_month", silver.quality_status().alias("quality_status"))
        .agg(F.count("*").alias("trips"))
    )


@query
def silver_trip_events(spark, sf_dir):
    return warehouse(spark, sf_dir).silver_trip_events.drop("transformed_at")


@query
def silver_quarantine(spark, sf_dir):
    return warehouse(spark, sf_dir).silver_quarantine.drop("transformed_at")


@query
def fact_trips(spark, sf_dir):
    return warehouse(spark, sf_dir).facts_by_load.drop("transformed_at")


@query
def silver_trips_view(spark, sf_dir):
    """The compatibility view, queried by name."""
    warehouse(spark, sf_dir).silver_trips.createOrReplaceTempView("silver_trips")
    return spark.sql(
        "SELECT trip_id, dataset_month, pickup_at, total_amount, quality_status FROM silver_trips"
    )


@query
def dim_zone(spark, sf_dir):
    return warehouse(spark, sf_dir).dim_zone


@query
def scalar_calendar(spark, sf_dir):
    at = "pickup_at"
    return warehouse(spark, sf_dir).stg_trips.select(
        at,
        month_text(at).alias("month"),
        weekday_name("dayofweek(pickup_at) - 1").alias("weekday_name"),
        weekday_number(at).alias("weekday_number"),
        F.hour(at).alias("hour"),
    )


# ---- marts --------------------------------------------------------------------


@query
def mart_daily_demand(spark, sf_dir):
    return warehouse(spark, sf_dir).mart_daily_demand


@query
def mart_zone_performance(spark, sf_dir):
    return warehouse(spark, sf_dir).mart_zone_performance


@query
def mart_hourly_pattern(spark, sf_dir):
    return warehouse(spark, sf_dir).mart_hourly_pattern


@query
def month_guard(spark, sf_dir):
    return marts.month_guard_report(warehouse(spark, sf_dir).facts_by_load)


@query
def daily_summary_local(spark, sf_dir):
    """Written as Parquet and read back, as the summary job does."""
    written = materialize(
        marts.daily_summary_local(adapters.trips_raw(spark, sf_dir)), "daily_summary"
    )
    return written.orderBy("trip_date")


# ---- incremental loads --------------------------------------------------------


def _fact_columns(df):
    return df.select(
        "trip_id",
        "dataset_month",
        "pickup_at",
        "trip_distance_miles",
        "total_amount",
        "quality_status",
    )


@query
def backfill_range(spark, sf_dir):
    return _fact_columns(warehouse(spark, sf_dir).fact_trips)


@query
def backfill_shared_hours(spark, sf_dir):
    """The facts of all months, ranking only the hours that several months hold."""
    built = written_warehouse(spark, sf_dir, *IDENTIFIED)
    return _fact_columns(facts.latest_of_shared_hours(built.facts_by_load))


@query
def contested_by_sketch(spark, sf_dir):
    """Trips that a month loaded again takes from others: sketches name the months, ids decide.

    Only ids are compared, so the facts are made of what the id is made of.
    """
    built = written_warehouse(spark, sf_dir, "trip_id", *IDENTITY_COLUMNS, "dataset_month", "quality_status")
    reloaded = built.facts_by_load.where(F.col("dataset_month") == RELOADED_MONTH)
    root = fresh_dir(spark, "lake")
    with snapshots.Commit(spark, root) as commit:
        commit.write(monthly.FACT, built.fact_trips, monthly.MONTH, derived=derived_id(built.fact_trips.columns))
        monthly.write_sketch(commit)
        commit.publish()
    sketch = snapshots.read(spark, root, monthly.SKETCH)
    suspects = [r[0] for r in sketches.answering_months(sketch, reloaded, [RELOADED_MONTH]).collect()]
    held = snapshots.read(spark, root, monthly.FACT, partitions=suspects)
    taken = held.join(reloaded.select("trip_id"), "trip_id", "left_semi")
    return taken.groupBy("dataset_month").agg(F.count("*").alias("trips"))


@query
def fact_incremental_merge(spark, sf_dir):
    """All months loaded in order, then one of them loaded again."""
    built = written_warehouse(spark, sf_dir, *IDENTIFIED)
    reloaded = built.facts_by_load.where(F.col("dataset_month") == RELOADED_MONTH)
    return _fact_columns(facts.merge_loads(built.fact_trips, reloaded, [RELOADED_MONTH]))


@query
def schema_sync_merge(spark, sf_dir):
    """Old facts lack one column and have one that the new load dropped."""
    built = written_warehouse(spark, sf_dir)
    old = built.fact_trips.drop("congestion_surcharge_amount").withColumn(
        "legacy_code", F.col("rate_code_id")
    )
    reloaded = built.facts_by_load.where(F.col("dataset_month") == RELOADED_MONTH)
    merged = facts.merge_loads(old, reloaded, [RELOADED_MONTH])
    return merged.select("trip_id", "dataset_month", "congestion_surcharge_amount").withColumn(
        "column_count", F.lit(len(merged.columns))
    )


@query
def gold_month_replace(spark, sf_dir):
    """Daily mart published from the final facts, one month then replaced by its own build's."""
    built = written_warehouse(spark, sf_dir, *MEASURES)
    root = fresh_dir(spark, "serving")
    final = marts.mart_daily_demand(marts.guarded(built.fact_trips))
    publish.publish_gold("mart_daily_demand", final, root)
    month = marts.mart_daily_demand(marts.guarded(built.facts_by_load, RELOADED_MONTH))
    publish.publish_gold("mart_daily_demand", month, root)
    return publish.read_gold(spark, root, "mart_daily_demand")


def _versioned_lake(spark, sf_dir):
    """Facts and a mart of all months as one version, then one month loaded again as the next."""
    built = written_warehouse(spark, sf_dir, *IDENTIFIED)
    root, mart, month = fresh_dir(spark, "lake"), "mart_daily_demand", "dataset_month"
    with snapshots.Commit(spark, root) as commit:
        commit.write("fact_trips", built.fact_trips, month, derived=derived_id(built.fact_trips.columns))
        final = marts.mart_daily_demand(marts.guarded(commit.staged("fact_trips")))
        commit.write(mart, publish.with_month(mart, final), month)
        commit.publish()
    with snapshots.Commit(spark, root) as commit:
        new = built.facts_by_load.where(F.col(month) == RELOADED_MONTH)
        monthly.merge_into_fact(commit, new, [RELOADED_MONTH])
        own = marts.mart_daily_demand(marts.guarded(new, RELOADED_MONTH))
        commit.write(mart, publish.with_month(mart, own), month, [RELOADED_MONTH])
        commit.publish()
    return root


@query
def snapshot_versions(spark, sf_dir):
    """Rows and amounts of two tables as each of two versions has them."""
    root = _versioned_lake(spark, sf_dir)
    found = []
    for version in snapshots.versions(spark, root):
        for table, amount in (("fact_trips", "total_amount"), ("mart_daily_demand", "revenue_amount")):
            rows = snapshots.read(spark, root, table, version).groupBy("dataset_month")
            added = rows.agg(F.count("*").alias("rows"), F.sum(F.col(amount).cast("decimal(18,2)")).alias("amount"))
            found.append(added.withColumns({"version": F.lit(version), "table_name": F.lit(table)}))
    return reduce(DataFrame.unionByName, found)


@query
def snapshot_sizes(spark, sf_dir):
    """Rows per table and month of the current version, from the manifest alone."""
    return snapshots.table_sizes(spark, _versioned_lake(spark, sf_dir)).select("table_name", "partition", "rows")


def _exported(spark, built):
    models = dict(built.models(*(name for name in publish.EXPORTS if name != "fact_trips")))
    root = fresh_dir(spark, "export")
    publish.export_models({**models, "fact_trips": built.facts_by_load}, root)
    return root


@query
def export_month_slice(spark, sf_dir):
    """Facts exported month by month and read back with their partitions."""
    root = fresh_dir(spark, "export")
    publish.export_model("fact_trips", warehouse(spark, sf_dir).facts_by_load, root)
    return publish.read_export(spark, root, "fact_trips").select(
        "trip_id", "year", "month", "total_amount"
    )


@query
def export_counts(spark, sf_dir):
    return publish.export_counts(spark, _exported(spark, written_warehouse(spark, sf_dir, *MEASURES)))


@query
def publish_manifest(spark, sf_dir):
    """Run documents written as JSON and read again: run fields and one row per export record."""
    built = written_warehouse(spark, sf_dir, *MEASURES)
    records = publish.export_records(spark, _exported(spark, built))
    run = runs.with_freshness(audit_table(spark, sf_dir, built.silver_trip_events))
    documents = publish.publish_manifest(run, records)
    path = fresh_dir(spark, "manifests")
    publish.write_manifest(documents, path)
    read = spark.read.schema(documents.schema).json(path)
    file_ok = F.forall(
        "export.file_list", lambda f: (F.length(f["sha256"]) == 64) & (f["bytes"] > 0) & f["uploaded"]
    )
    return read.withColumn("export", F.explode_outer("exports")).select(
        "run_id",
        "dataset_month",
        "status",
        "bronze_rows",
        "silver_rows",
        "rejected_rows",
        "freshness_sla_met",
        F.col("export.model").alias("model"),
        F.col("export.rows").alias("rows"),
        (file_ok & (F.col("export.bytes") > 0) & (F.size("export.file_list") == F.col("export.files"))).alias("verifiable"),
    )


# ---- runs and checks ----------------------------------------------------------


@query
def run_metrics(spark, sf_dir):
    return runs.run_metrics(
        bronze_by_month(spark, sf_dir), warehouse(spark, sf_dir).silver_trip_events
    )


@query
def freshness_check(spark, sf_dir):
    return runs.with_freshness(adapters.runs_raw(spark, sf_dir)).select(
        "run_id", "duration_seconds", "freshness_sla_hours", "freshness_sla_met"
    )


@query
def quality_gate(spark, sf_dir):
    return runs.expectations(runs.with_freshness(audit_table(spark, sf_dir)))


@query
def volume_anomaly(spark, sf_dir):
    history = materialize(adapters.runs_raw(spark, sf_dir), "pipeline_runs")
    return runs.volume_history(history)


@query
def audit_upsert(spark, sf_dir):
    """Failed runs are repeated under their id; December gets a second run under a new id."""
    history = materialize(audit_table(spark, sf_dir), "pipeline_runs")
    month = F.col("dataset_month")
    later = {name: F.timestamp_add("DAY", F.lit(1), F.col(name)) for name in ("started_at", "completed_at")}
    again = history.where(month.endswith("-07")).withColumns({**later, "status": F.lit("success")})
    second = history.where(month.endswith("-12")).withColumns(
        {**later, "run_id": F.concat(F.lit("second-"), month)}
    )
    incoming = again.unionByName(second).withColumn(
        "details", runs.details_json("run_id", "status", "bronze_rows")
    )
    return runs.audit_upsert(history, incoming)


@query
def test_not_null(spark, sf_dir):
    built = written_warehouse(spark, sf_dir, *IDENTIFIED)
    return checks.check_not_null(built.models(*checks.NOT_NULL))


@query
def test_unique(spark, sf_dir):
    built = written_warehouse(spark, sf_dir, *IDENTIFIED)
    return checks.check_unique(built.models(*checks.UNIQUE))


@query
def test_accepted_values(spark, sf_dir):
    return checks.check_accepted_values(warehouse(spark, sf_dir).silver_trip_events)


@query
def test_relationships(spark, sf_dir):
    built = warehouse(spark, sf_dir)
    return checks.check_relationships(built.fact_trips, built.dim_zone)


@query
def test_quarantine_rate(spark, sf_dir):
    return checks.check_quarantine_rate(warehouse(spark, sf_dir).silver_trip_events)


@query
def test_gold_grains(spark, sf_dir):
    built = written_warehouse(spark, sf_dir, *MEASURES)
    return checks.check_gold_grains(built.models(*checks.GRAINS))


# ---- maintenance --------------------------------------------------------------


@query
def month_coverage(spark, sf_dir):
    return maintenance.month_coverage(warehouse(spark, sf_dir).facts_by_load, *COVERAGE_RANGE)


@query
def boundary_cleanup(spark, sf_dir):
    """Marts built without the month guard, cleaned of months no successful run has loaded."""
    built = written_warehouse(spark, sf_dir, *MEASURES)
    history = materialize(adapters.runs_raw(spark, sf_dir), "pipeline_runs")
    successful = history.where("status = 'success'").select("dataset_month")
    loaded = built.facts_by_load.join(successful, "dataset_month", "left_semi")
    gold = {
        "mart_daily_demand": marts.mart_daily_demand(loaded),
        "mart_zone_performance": marts.mart_zone_performance(loaded, built.dim_zone),
    }
    return maintenance.boundary_cleanup(gold, maintenance.fact_months(loaded))


@query
def year_validation(spark, sf_dir):
    built = written_warehouse(spark, sf_dir, *IDENTIFIED)
    return maintenance.year_validation(built.fact_trips, built.mart_daily_demand, VALIDATED_YEAR)


@query
def warehouse_inspect(spark, sf_dir):
    return maintenance.warehouse_inspect(warehouse(spark, sf_dir).fact_trips)


@query
def table_counts(spark, sf_dir):
    built = written_warehouse(spark, sf_dir, *MEASURES)
    return maintenance.table_counts(
        {
            "daily": built.mart_daily_demand,
            "zone": built.mart_zone_performance,
            "hourly": built.mart_hourly_pattern,
            "audit": adapters.runs_raw(spark, sf_dir),
        }
    )


# ---- dashboards ---------------------------------------------------------------


@query
def kpi_latest_day(spark, sf_dir):
    return dashboards.kpi_latest_day(warehouse(spark, sf_dir).mart_daily_demand)


@query
def daily_trend(spark, sf_dir):
    return dashboards.daily_trend(warehouse(spark, sf_dir).mart_daily_demand)


@query
def daily_trend_chart(spark, sf_dir):
    return dashboards.daily_trend_chart(warehouse(spark, sf_dir).mart_daily_demand)


@query
def top_zones(spark, sf_dir):
    return dashboards.top_zones(warehouse(spark, sf_dir).mart_zone_performance)


@query
def zone_table(spark, sf_dir):
    return dashboards.zone_table(warehouse(spark, sf_dir).mart_zone_performance)


@query
def demand_heatmap(spark, sf_dir):
    return dashboards.demand_heatmap(warehouse(spark, sf_dir).mart_hourly_pattern)


@query
def demand_heatmap_chart(spark, sf_dir):
    return dashboards.demand_heatmap_chart(warehouse(spark, sf_dir).mart_hourly_pattern)


@query
def kpi_totals(spark, sf_dir):
    return dashboards.kpi_totals(warehouse(spark, sf_dir).mart_daily_demand)


@query
def kpi_rejection_rate(spark, sf_dir):
    return dashboards.kpi_rejection_rate(audit_table(spark, sf_dir))


@query
def quality_panel(spark, sf_dir):
    return dashboards.quality_panel(audit_table(spark, sf_dir))


# ---- streaming ----------------------------------------------------------------


def _replayed(spark, events, files_per_batch=None):
    path = fresh_dir(spark, "replay")
    replay.to_events(events).write.option("maxRecordsPerFile", EVENTS_PER_FILE).text(path)
    return stream.file_messages(spark, path, files_per_batch)


def _streamed(spark, messages, watermark=None, max_events=None, position=None):
    output, checkpoint = fresh_dir(spark, "minutes"), fresh_dir(spark, "progress")
    stream.start_minute_zone(
        messages, output, checkpoint, STATE_PARTITIONS, watermark, max_events, position
    ).awaitTermination()
    return stream.read_minute_zone(spark, output).drop("updated_at")


@query
def replay_events(spark, sf_dir):
    """Events after a round trip through their JSON form."""
    received = replay.parse_events(replay.to_events(adapters.trip_events(spark, sf_dir)))
    return received.select(*replay.EVENT_COLUMNS)


@query
def stream_minute_zone(spark, sf_dir):
    return _streamed(spark, _replayed(spark, adapters.trip_events(spark, sf_dir)))


@query
def stream_minute_zone_watermarked(spark, sf_dir):
    return _streamed(spark, _replayed(spark, adapters.trip_events(spark, sf_dir)), WATERMARK)


@query
def stream_bounded_replay(spark, sf_dir):
    """All events are sent, numbered in replay order; the stream counts the first ones."""
    sent = replay.numbered(adapters.trip_events(spark, sf_dir), "event_id")
    return _streamed(spark, _replayed(spark, sent), max_events=BOUNDED_EVENTS, position=replay.position())


@query
def stream_rejects(spark, sf_dir):
    """Rejected events of a replay of the raw trips, some of which have no zone."""
    messages = _replayed(spark, adapters.trips_raw(spark, sf_dir))
    output, checkpoint = fresh_dir(spark, "rejects"), fresh_dir(spark, "progress")
    stream.start_rejects(messages, output, checkpoint).awaitTermination()
    rejected = spark.read.parquet(output)
    return replay.parse_events(rejected).select(
        "tpep_pickup_datetime", "trip_distance", "total_amount", "reject_reason"
    )
