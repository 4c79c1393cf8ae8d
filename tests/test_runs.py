from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmill.operators import checks, maintenance, runs

AUDIT = (
    "run_id string, dataset_month string, status string, bronze_rows long, silver_rows long, "
    "rejected_rows long, started_at timestamp, completed_at timestamp, details string"
)


def run(run_id, rows=100, status="success", day=1, month="2024-01", started=None, details="{}"):
    done = datetime(2024, 3, day, 6)
    return (run_id, month, status, rows, 99, 1, started or datetime(2024, 3, day, 5), done, details)


def metrics(spark, bronze=100, silver=99, rate=1.0, fresh=True):
    return spark.createDataFrame(
        [("2024-01", bronze, silver, rate, fresh)],
        "dataset_month string, bronze_rows long, silver_rows long, rejected_rate_pct double, freshness_sla_met boolean",
    )


@pytest.mark.parametrize(
    ("change", "passes"),
    [
        ({}, True),
        ({"rate": 5.0}, True),
        ({"rate": 5.0001}, False),
        ({"rate": 6.0}, False),
        ({"rate": None}, False),
        ({"bronze": 0}, False),
        ({"silver": 0}, False),
        ({"fresh": False}, False),
    ],
)
def test_gate(spark, change, passes):
    rows = runs.expectations(metrics(spark, **change)).collect()
    assert len(rows) == 4
    assert all(row.success for row in rows) is passes


def test_freshness_limit(spark):
    frame = spark.createDataFrame(
        [
            (datetime(2024, 1, 1), datetime(2024, 1, 2)),
            (datetime(2024, 1, 1), datetime(2024, 1, 2, 0, 0, 0, 1)),
            (datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1, 234567)),
        ],
        "started_at timestamp, completed_at timestamp",
    )
    rows = runs.with_freshness(frame).collect()
    assert [row.freshness_sla_met for row in rows] == [True, False, True]
    assert rows[2].duration_seconds == 1.235


def test_volume_uses_the_latest_seven_successes(spark):
    history = [run(f"r{i}", rows=i * 10, day=i) for i in range(1, 11)]
    history += [run("failed", rows=10**6, status="failed", day=20), run("unknown", rows=None, day=21)]
    audit = spark.createDataFrame(history, AUDIT)
    row = runs.with_volume_check(metrics(spark, bronze=91), audit).first()
    assert row.volume_baseline_rows == 70.0
    assert row.volume_deviation_pct == 30.0 and not row.volume_anomaly_warning
    assert runs.with_volume_check(metrics(spark, bronze=92), audit).first().volume_anomaly_warning


def test_volume_without_history_or_with_zero_baseline(spark):
    empty = spark.createDataFrame([], AUDIT)
    row = runs.with_volume_check(metrics(spark), empty).first()
    assert row.volume_baseline_rows is None and not row.volume_anomaly_warning
    zero = spark.createDataFrame([run("r", rows=0)], AUDIT)
    row = runs.with_volume_check(metrics(spark), zero).first()
    assert row.volume_baseline_rows == 0.0 and row.volume_deviation_pct is None


def test_volume_history_equals_a_check_at_every_run(spark):
    rows = []
    for i in range(1, 29):
        status = "failed" if i % 5 == 0 else "success"
        # Several runs share a day; they are ordered by their id.
        rows.append(run(f"r{i:02d}", rows=(i * 37) % 100 or None, status=status, day=1 + i // 3))
    audit = spark.createDataFrame(rows, AUDIT)
    got = {r.run_id: r for r in runs.volume_history(audit).collect()}
    assert len(got) == len(rows)
    for position, current in enumerate(rows):
        before = [r[3] for r in rows[:position] if r[2] == "success" and r[3] is not None][-7:]
        expected = round(sum(before) / len(before), 2) if before else None
        baseline = got[current[0]].volume_baseline_rows
        assert baseline == (pytest.approx(expected, abs=0.011) if before else None)


def test_audit_upsert(spark):
    old = spark.createDataFrame([run("a", started=datetime(2020, 1, 1), month="2024-01"), run("b")], AUDIT)
    new = spark.createDataFrame([run("a", rows=5, status="failed", day=9, month="1999-01", details="new"), run("c")], AUDIT)
    rows = {r.run_id: r for r in runs.audit_upsert(old, new).collect()}
    assert set(rows) == {"a", "b", "c"}
    a = rows["a"]
    assert (a.dataset_month, a.started_at) == ("2024-01", datetime(2020, 1, 1))
    assert (a.status, a.bronze_rows, a.completed_at, a.details) == ("failed", 5, datetime(2024, 3, 9, 6), "new")
    again = runs.audit_upsert(runs.audit_upsert(old, new), new)
    assert sorted(again.collect()) == sorted(rows.values())


def test_checks_report_failures(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,)], "zone_id int")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "z int")
    assert checks.relationships("c", child, ["z"], parent, "zone_id").first().failures == 2
    assert checks.unique({"p": "zone_id"}, parent).first().failures == 1
    assert checks.unique({"c": "z"}, child.where("z is null")).first().failures == 0
    assert checks.not_null({"c": ["z"]}, child).first().failures == 1
    assert checks.not_null({"stg_trips": ["z"]}, child).first().severity == "warn"
    assert checks.accepted_values("c", child, "z", [1, 2]).first().failures == 1


def test_quarantine_limit_is_strict(spark):
    events = spark.range(100).select(
        F.lit("2024-01").alias("dataset_month"),
        F.when(F.col("id") < 5, "missing_zone").otherwise("accepted").alias("quality_status"),
    )
    assert checks.check_quarantine_rate(events).count() == 0
    assert checks.check_quarantine_rate(events.limit(99)).count() in (0, 1)
    assert checks.check_quarantine_rate(events.where("quality_status != 'accepted'")).first().total_rows == 5


def test_gold_grain_duplicates(spark):
    zone = spark.createDataFrame([("d", 1), ("d", 1), ("d", 2)], "trip_date string, zone_id int")
    hourly = spark.createDataFrame([("m", 0, 1)], "dataset_month string, weekday_number int, pickup_hour int")
    rows = checks.check_gold_grains({"mart_zone_performance": zone, "mart_hourly_pattern": hourly}).collect()
    assert {r.model: r.duplicate_grains for r in rows} == {"mart_zone_performance": 1, "mart_hourly_pattern": 0}


def test_month_spine(spark):
    months = [r.dataset_month for r in maintenance.month_spine(spark, "2024-11", "2025-02").collect()]
    assert months == ["2024-11", "2024-12", "2025-01", "2025-02"]
    with pytest.raises(ValueError, match="after end month"):
        maintenance.month_spine(spark, "2025-01", "2024-12")
    with pytest.raises(ValueError):
        maintenance.month_spine(spark, "2024-13", "2025-01")


def test_cleanup_refuses_without_fact_months(spark):
    with pytest.raises(RuntimeError, match="holds no month"):
        maintenance.require_fact_months(spark.createDataFrame([], "dataset_month string"))


def test_boundary_split(spark):
    gold = spark.sql("SELECT explode(array(DATE '2024-01-31', DATE '2024-02-01')) AS trip_date, 1 AS n")
    months = spark.createDataFrame([("2024-01",)], "dataset_month string")
    kept, stray = maintenance.boundary_split(gold, months)
    assert [str(r.trip_date) for r in kept.collect()] == ["2024-01-31"]
    assert [str(r.trip_date) for r in stray.collect()] == ["2024-02-01"]
    report = maintenance.boundary_cleanup({"m": gold}, months).first()
    assert (report.rows_before, report.rows_after, report.deleted_rows) == (2, 1, 1)


def test_checks_of_a_view_and_its_table_share_one_pass(spark):
    fact = spark.createDataFrame([("a", "2024-01"), ("a", "2024-01"), (None, "2024-01")], "trip_id string, dataset_month string")
    models = dict.fromkeys(("silver_trips", "fact_trips"), fact)
    nulls = checks.not_null({m: checks.NOT_NULL[m] for m in models}, fact)
    assert nulls._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1
    assert sorted((r.model, r.column_name, r.failures) for r in nulls.collect()) == [
        ("fact_trips", "dataset_month", 0),
        ("fact_trips", "trip_id", 1),
        ("silver_trips", "trip_id", 1),
    ]
    repeats = checks.unique({m: checks.UNIQUE[m] for m in models}, fact).collect()
    assert sorted((r.model, r.failures) for r in repeats) == [("fact_trips", 1), ("silver_trips", 1)]
