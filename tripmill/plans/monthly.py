"""Monthly loads: bronze partitions in, facts, marts, audit and manifests out.

A load covers one month or many; a backfill is a load of every landed month in
a range. Running a load again leaves every table as it was.

Tables below the lake root:

    bronze/trips/year=/month=          landed trips
    bronze/zones                       landed zone lookup (CSV)
    tables/silver_trip_events          scored events, by dataset_month
    tables/fact_trips                  the trip fact, by dataset_month
    tables/fact_key_sketch             which trips a fact month may hold, by dataset_month
    tables/dim_zone                    zones
    tables/<mart>                      marts, by dataset_month
    tables/pipeline_runs               one row per run, by dataset_month
    snapshots/                         versions of all these tables together
    quality/                           gate results (JSON)

A load changes its tables in one commit: readers see all of it or nothing, and
older versions stay readable until they are removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import derived_id
from tripmill.operators import facts, maintenance, marts, runs, silver, sketches, staging
from tripmill.plans import publish
from tripmill.session import prepare
from tripmill.sources import bronze, snapshots
from tripmill.sources.lake import delete, materialize, read_table, replace_partitions
from tripmill.sources.snapshots import Commit

MONTH = "dataset_month"
EVENTS, FACT, ZONES, AUDIT = "silver_trip_events", "fact_trips", "dim_zone", "pipeline_runs"
SKETCH = "fact_key_sketch"
MARTS = ("mart_daily_demand", "mart_zone_performance", "mart_hourly_pattern")


class GateError(RuntimeError):
    """At least one month did not pass the quality gate; it was not loaded."""


def trips_path(root: str) -> str:
    return f"{root}/bronze/trips"


def zones_path(root: str) -> str:
    return f"{root}/bronze/zones"


def stored(
    spark: SparkSession, root: str, table: str, months: Sequence[str] | None = None, version: int | None = None
) -> DataFrame:
    """A stored table of the current or a given version; with months, only their files are opened."""
    found = snapshots.read(spark, root, table, version, months)
    if found is None:
        raise LookupError(f"{root} holds no {table}")
    return found


def stored_gold(
    spark: SparkSession, root: str, model: str, months: Sequence[str] | None = None, version: int | None = None
) -> DataFrame:
    """A mart in its own columns."""
    table = stored(spark, root, model, months, version)
    return table if publish.EXPORTS[model][1] == MONTH else table.drop(MONTH)


def _of_months(df: DataFrame, months: Sequence[str]) -> DataFrame:
    return df.where(F.col("dataset_month").isin(*months))


def _values(months: DataFrame) -> list[str]:
    """Month names on the driver: one per calendar month at most."""
    return [row[0] for row in months.collect()]


def checked_months(spark: SparkSession, root: str, months: Sequence[str]) -> tuple[list[str], dict[str, str]]:
    """Months whose own files meet the contract, and why each of the others does not."""
    landed = set(bronze.landed_months(spark, trips_path(root)))
    refused = {m: "has not landed" for m in months if m not in landed}
    report = bronze.contract_report(spark, trips_path(root), [m for m in months if m in landed])
    for row in report.collect():  # one row per month
        if row.missing_columns:
            refused[row.dataset_month] = f"missing required columns: {row.missing_columns}"
        elif row.unreadable:
            refused[row.dataset_month] = f"a file cannot be read: {row.unreadable}"
        elif not row.accepted:
            refused[row.dataset_month] = "the files hold no rows"
    return [m for m in months if m not in refused], refused


def build_events(commit: Commit, landed: DataFrame) -> DataFrame:
    """Stage, deduplicate and score landed months; written once, shown only for months that pass the gate."""
    events = silver.silver_trip_events(staging.stg_trips(landed, F.col("dataset_month")))
    return commit.stage(EVENTS, events, MONTH, derived=derived_id(events.columns))


def build_zones(spark: SparkSession, root: str) -> DataFrame:
    """Zones are a full snapshot of the lookup file each time."""
    return staging.dim_zone(staging.stg_zones(bronze.read_zones(spark, zones_path(root))))


def contested_months(commit: Commit, new: DataFrame, months: Sequence[str]) -> list[str]:
    """Months outside the load that hold a trip it now owns.

    Only months whose sketch answers are read, and months without a sketch.
    """
    sketch = commit.read(SKETCH)
    answers = [] if sketch is None else _values(sketches.answering_months(sketch, new, months))
    others = commit.held(FACT) - set(months)
    suspects = sorted((others - commit.held(SKETCH)) | (others & set(answers)))
    return _values(facts.contested_months(commit.read(FACT, suspects), new, months)) if suspects else []


def write_sketch(commit: Commit, touched: Sequence[str] | None = None) -> None:
    """Sketch the fact months this commit has written; the sketches of all others stay as they are."""
    commit.write(SKETCH, sketches.key_sketch(commit.staged(FACT)), MONTH, touched, sketches.ORDER)


def merge_into_fact(commit: Commit, new: DataFrame, months: Sequence[str]) -> list[str]:
    """Put a load into the fact table, rewriting only the months it touches.

    Those are the loaded months and the ones that held a trip the load now owns.
    A touched month without a merged row has lost its last trip and is removed.
    Returns the touched months.
    """
    if commit.read(FACT) is None:
        commit.write(FACT, new, MONTH, derived=derived_id(new.columns))
        return list(months)
    contested = contested_months(commit, new, months)
    merged = facts.merge_loads(commit.read(FACT, contested), new, months)
    touched = [*months, *contested]
    commit.write(FACT, merged, MONTH, touched)
    return touched


def write_gold(commit: Commit, accepted: DataFrame, zones: DataFrame, months: Sequence[str]) -> None:
    """Rebuild the marts of the given months from their own accepted events."""
    inside = marts.guarded(accepted, *months)
    built = {
        "mart_daily_demand": marts.mart_daily_demand(inside),
        "mart_zone_performance": marts.mart_zone_performance(inside, zones),
        "mart_hourly_pattern": marts.mart_hourly_pattern(inside),
    }
    for model, mart in built.items():
        commit.write(model, publish.with_month(model, mart), MONTH, months)


def read_audit(spark: SparkSession, root: str) -> DataFrame | None:
    return snapshots.read(spark, root, AUDIT)


def record_runs(commit: Commit, incoming: DataFrame) -> None:
    """Upsert runs; the audit table is small, one row per run."""
    incoming = incoming.select(*runs.AUDIT_COLUMNS)
    audit = commit.read(AUDIT)
    merged = incoming if audit is None else runs.audit_upsert(audit, incoming)
    commit.write(AUDIT, merged, MONTH)


def _metrics(
    commit: Commit,
    landed: DataFrame,
    events: DataFrame,
    run_id: str,
    started_at: datetime,
    work: str,
) -> DataFrame:
    measured = runs.run_metrics(landed, events).withColumns(
        {
            "run_id": F.concat_ws("-", F.lit(run_id), "dataset_month"),
            "started_at": F.lit(started_at),
            "completed_at": F.lit(datetime.now(UTC)),
        }
    )
    measured = runs.with_freshness(measured)
    audit = commit.read(AUDIT)
    if audit is None:
        audit = measured.limit(0).withColumn("status", F.lit("none"))
    # A few rows, one per month; stored so that later steps do not count again.
    checked = runs.with_volume_check(measured, audit)
    checked.write.parquet(f"{work}/metrics")
    return commit.spark.read.schema(checked.schema).parquet(f"{work}/metrics")


def load_months(
    spark: SparkSession,
    root: str,
    months: Sequence[str],
    run_id: str,
    started_at: datetime | None = None,
) -> DataFrame:
    """Load landed months; returns their metrics.

    A month whose own files break the contract is refused, and one that fails
    the gate is recorded as failed. Either keeps everything that was loaded for it
    before, quarantine included, and makes the call raise once the other months
    are in. Facts, marts, zones and audit become visible together; a load that is
    lost on the way has changed nothing, and one that another load has overtaken
    raises ``ConflictError`` and can be run again. Intermediate tables live in a work folder below the lake root that
    is removed at the end, whatever happens.
    """
    prepare(spark)
    work = f"{root}/_work/{run_id}-{uuid.uuid4().hex}"
    try:
        return _load(spark, root, sorted(set(months)), run_id, started_at or datetime.now(UTC), work)
    finally:
        delete(spark, work)


def _load(
    spark: SparkSession, root: str, months: Sequence[str], run_id: str, started_at: datetime, work: str
) -> DataFrame:
    months, refused = checked_months(spark, root, months)
    if not months:
        raise bronze.ContractError(f"refused months: {refused}")
    landed = bronze.read_bronze(spark, trips_path(root), months)
    with Commit(spark, root) as commit:
        metrics, failed = _change(commit, landed, months, run_id, started_at, work)
        commit.publish()
    # The stored metrics go with the work folder; what is returned is a row per month.
    kept = spark.createDataFrame(metrics.collect(), metrics.schema)
    if refused:
        raise bronze.ContractError(f"refused months: {refused}")
    if failed:
        raise GateError(f"months that failed the quality gate: {failed}")
    return kept


def _change(
    commit: Commit, landed: DataFrame, months: Sequence[str], run_id: str, started_at: datetime, work: str
) -> tuple[DataFrame, list[str]]:
    """All that a load writes; returns the metrics and the months that failed the gate."""
    spark, root = commit.spark, commit.root
    events = build_events(commit, landed)
    metrics = _metrics(commit, landed, events, run_id, started_at, work)

    results = runs.expectations(metrics)
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "dataset_month"
    ).json(f"{root}/quality")
    verdicts = results.groupBy("dataset_month").agg(F.bool_and("success").alias("passed")).collect()
    passed = sorted(row.dataset_month for row in verdicts if row.passed)
    failed = sorted(set(months) - set(passed))

    if passed:
        commit.put(EVENTS, events.schema, MONTH, passed)
        zones = commit.write(ZONES, build_zones(spark, root))
        accepted = silver.accepted(_of_months(events, passed))
        new = accepted
        if len(passed) > 1:  # within one month every trip is unique already
            last = facts.latest_of_shared_hours(accepted)
            replace_partitions(last, f"{work}/new", [MONTH], derived=derived_id(last.columns))
            new = read_table(spark, f"{work}/new", accepted.schema)
        write_sketch(commit, merge_into_fact(commit, new, passed))
        write_gold(commit, accepted, zones, passed)
    finished = metrics.withColumn(
        "status",
        F.when(F.col("dataset_month").isin(*passed), "success").otherwise("failed"),
    ).withColumn("details", F.to_json(F.struct(*metrics.columns)))
    record_runs(commit, finished)
    return metrics, failed


def backfill(
    spark: SparkSession,
    root: str,
    start: str,
    end: str,
    run_id: str,
    started_at: datetime | None = None,
) -> DataFrame:
    """Load every landed month of the range in one job; returns the month coverage.

    The result is that of loading the months one after another: among the
    loaded months the last one owns a trip. Months that have not landed are
    reported and skipped.
    """
    names = bronze.landed_months(prepare(spark), trips_path(root))
    landed = spark.createDataFrame([(name,) for name in names], "dataset_month string")
    coverage = maintenance.month_coverage(landed, start, end)
    months = _values(coverage.where("available").select("dataset_month"))
    if months:
        load_months(spark, root, months, run_id, started_at)
    return coverage


def models(
    spark: SparkSession, root: str, months: Sequence[str] | None = None, version: int | None = None
) -> dict[str, DataFrame]:
    """Stored models by name, ready for the checks, dashboards and exports; all of one version."""
    version = snapshots.current(spark, root) if version is None else version
    events = stored(spark, root, EVENTS, months, version)
    fact = stored(spark, root, FACT, months, version)
    return {
        "silver_trip_events": events,
        "silver_quarantine": silver.silver_quarantine(events),
        "fact_trips": fact,
        "silver_trips": fact,
        "dim_zone": stored(spark, root, ZONES, version=version),
        **{model: stored_gold(spark, root, model, months, version) for model in MARTS},
    }


def export_month(spark: SparkSession, root: str, destination: str, dataset_month: str) -> DataFrame:
    """Export a month's slices and write its manifest; returns the export records."""
    version = snapshots.current(spark, root)
    publish.export_models(models(spark, root, [dataset_month], version), destination, dataset_month)
    records = publish.export_records(spark, destination, dataset_month)
    run = stored(spark, root, AUDIT, [dataset_month], version).where(F.col("status") == "success")
    publish.write_manifest(publish.publish_manifest(run, records), f"{destination}/manifests")
    return records


def clean_boundaries(spark: SparkSession, root: str) -> DataFrame:
    """Remove gold partitions of months without facts; returns what was removed.

    Which months have facts or gold is read from the manifest, and the removal is a commit of its own.
    """
    with Commit(spark, root) as commit:
        held = snapshots.table_sizes(spark, root, commit.base).where("rows > 0")
        months = held.where(F.col("table_name") == FACT).select(F.col("partition").alias("dataset_month"))
        maintenance.require_fact_months(months)
        gold = {model: stored_gold(spark, root, model, version=commit.base) for model in MARTS[:2]}
        report = materialize(maintenance.boundary_cleanup(gold, months), "boundary_cleanup")
        known = set(_values(months))
        for model in gold:
            stray = set(_values(held.where(F.col("table_name") == model).select("partition"))) - known
            if stray:
                commit.put(model, stored(spark, root, model, version=commit.base).schema, MONTH, sorted(stray))
        commit.publish()
    return report
