"""Run metrics, gates, history checks and the audit table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions import round_half_away
from tripmill.operators.silver import ACCEPTED

FRESHNESS_HOURS = 24
MAX_REJECTED_PCT = 5.0
HISTORY_RUNS = 7
MAX_DEVIATION_PCT = 30.0

AUDIT_COLUMNS = (
    "run_id",
    "dataset_month",
    "status",
    "bronze_rows",
    "silver_rows",
    "rejected_rows",
    "started_at",
    "completed_at",
    "details",
)


def run_metrics(bronze: DataFrame, events: DataFrame) -> DataFrame:
    """Per month: raw, accepted and rejected rows, rejected percentage of the raw rows.

    Bronze counts read one column; both sides shrink to month grain before the
    only join-free shuffle they share.
    """
    zero = F.lit(0).cast("bigint")
    raw = bronze.select(
        "dataset_month", F.lit(1).alias("bronze"), zero.alias("silver"), zero.alias("rejected")
    )
    good = F.col("quality_status") == ACCEPTED
    scored = events.select(
        "dataset_month",
        F.lit(0).alias("bronze"),
        F.when(good, 1).otherwise(0).alias("silver"),
        F.when(good, 0).otherwise(1).alias("rejected"),
    )
    counted = (
        raw.unionByName(scored)
        .groupBy("dataset_month")
        .agg(
            F.sum("bronze").alias("bronze_rows"),
            F.sum("silver").alias("silver_rows"),
            F.sum("rejected").alias("rejected_rows"),
        )
    )
    return counted.withColumn(
        "rejected_rate_pct",
        round_half_away("100D * rejected_rows / greatest(bronze_rows, 1)", 4),
    )


def with_freshness(runs: DataFrame) -> DataFrame:
    """Run duration and whether it stayed within the freshness limit."""
    seconds = "(unix_micros(completed_at) - unix_micros(started_at)) / 1e6D"
    return runs.withColumns(
        {
            "duration_seconds": round_half_away(seconds, 3),
            "freshness_sla_hours": F.lit(FRESHNESS_HOURS),
            "freshness_sla_met": F.expr(f"{seconds} <= {FRESHNESS_HOURS * 3600}"),
        }
    )


def expectations(metrics: DataFrame) -> DataFrame:
    """Gate results as rows: one per run month and expectation."""

    def row(name: str, observed: Column, success: Column) -> Column:
        return F.struct(
            F.lit(name).alias("expectation"),
            observed.cast("double").alias("observed"),
            F.coalesce(success, F.lit(False)).alias("success"),
        )

    rate = F.col("rejected_rate_pct")
    rows = F.array(
        row("bronze_rows_at_least_one", F.col("bronze_rows"), F.col("bronze_rows") >= 1),
        row("silver_rows_at_least_one", F.col("silver_rows"), F.col("silver_rows") >= 1),
        row("rejected_rate_within_limit", rate, rate.between(0.0, MAX_REJECTED_PCT)),
        row(
            "freshness_sla_met",
            F.col("freshness_sla_met").cast("int"),
            F.col("freshness_sla_met"),
        ),
    )
    return metrics.select("dataset_month", F.explode(rows).alias("r")).select("dataset_month", "r.*")


def _deviation(df: DataFrame) -> DataFrame:
    """Deviation columns from ``bronze_rows`` and ``baseline``; no baseline, no warning."""
    deviation = "try_divide(100D * (bronze_rows - baseline), baseline)"
    return df.withColumns(
        {
            "volume_baseline_rows": round_half_away("baseline", 2),
            "volume_deviation_pct": round_half_away(deviation, 4),
            "volume_anomaly_warning": F.expr(
                f"coalesce(abs({deviation}) > {MAX_DEVIATION_PCT}D, false)"
            ),
        }
    ).drop("baseline")


def _counts_as_history() -> Column:
    return (F.col("status") == "success") & F.col("bronze_rows").isNotNull()


def with_volume_check(metrics: DataFrame, audit: DataFrame) -> DataFrame:
    """Compare a run's metrics with the latest successful runs on record."""
    recent = (
        audit.where(_counts_as_history())
        .orderBy(F.col("completed_at").desc_nulls_first(), "run_id")
        .limit(HISTORY_RUNS)
    )
    baseline = recent.agg(F.avg("bronze_rows")).first()[0]
    return _deviation(metrics.withColumn("baseline", F.lit(baseline).cast("double")))


def volume_history(audit: DataFrame) -> DataFrame:
    """The same comparison for every completed run on record against the runs before it.

    Successful runs are numbered across the whole history without sorting it in
    one task: a number is the count of earlier days plus the rank within the day.
    Only the per-day counts (calendar sized) meet in one window. Each success
    then hands its rows to the next seven positions.
    """
    success = _counts_as_history()
    day = F.to_date("completed_at")
    within_day = Window.partitionBy("day").orderBy("completed_at", "run_id")
    ranked = (
        audit.where(F.col("completed_at").isNotNull())
        .withColumn("day", day)
        .withColumn("success", success)
        .withColumn("earlier_today", F.count_if("success").over(within_day) - F.col("success").cast("int"))
    )
    days = (
        ranked.groupBy("day")
        .agg(F.count_if("success").alias("n"))
        .select(
            "day",
            (F.sum("n").over(Window.orderBy("day")) - F.col("n")).alias("earlier_days"),
        )
    )
    placed = ranked.join(days, "day").withColumn("position", F.col("earlier_days") + F.col("earlier_today"))
    baselines = (
        placed.where("success")
        .select(
            F.explode(F.sequence(F.col("position") + 1, F.col("position") + HISTORY_RUNS)).alias("position"),
            "bronze_rows",
        )
        .groupBy("position")
        .agg(F.avg("bronze_rows").alias("baseline"))
    )
    return _deviation(placed.join(baselines, "position", "left")).select(
        "run_id",
        "dataset_month",
        "bronze_rows",
        "volume_baseline_rows",
        "volume_deviation_pct",
        "volume_anomaly_warning",
    )


def details_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def audit_upsert(audit: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert new runs, refresh known ones.

    A known run keeps its month and start; everything else comes from the new row.
    """
    kept = ("dataset_month", "started_at")
    old, new = audit.alias("old"), incoming.alias("new")
    is_new = F.col("new.run_id").isNotNull()
    columns = [F.coalesce("old.run_id", "new.run_id").alias("run_id")]
    for name in AUDIT_COLUMNS[1:]:
        if name in kept:
            value = F.when(F.col("old.run_id").isNotNull(), F.col(f"old.{name}")).otherwise(F.col(f"new.{name}"))
        else:
            value = F.when(is_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))
        columns.append(value.alias(name))
    return old.join(new, F.col("old.run_id") == F.col("new.run_id"), "full_outer").select(*columns)


