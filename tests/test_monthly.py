from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from helpers import trips

from tripmill.operators import checks, dashboards, maintenance
from tripmill.plans import monthly, publish
from tripmill.sources import bronze, snapshots

# January holds three trips; February has one of them again, a late one and its own.
JANUARY = [
    {},
    {"VendorID": 2},
    {"tpep_pickup_datetime": datetime(2024, 1, 31, 20, 0), "tpep_dropoff_datetime": datetime(2024, 1, 31, 20, 9)},
]
FEBRUARY = [
    {"file_month": "2024-02", "trip_distance": 9.0},
    {
        "file_month": "2024-02",
        "tpep_pickup_datetime": datetime(2024, 2, 5, 8, 0),
        "tpep_dropoff_datetime": datetime(2024, 2, 5, 8, 30),
    },
]


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    bronze.write_bronze(trips(spark, *JANUARY, *FEBRUARY), monthly.trips_path(root))
    zones = spark.createDataFrame(
        [("100", "Queens", "A", "B"), ("200", "Bronx", "C", "D")],
        "LocationID string, Borough string, Zone string, service_zone string",
    )
    zones.write.csv(monthly.zones_path(root), header=True)
    return root


def state(spark, root):
    models = monthly.models(spark, root)
    fact = sorted(
        (r.dataset_month, r.trip_id, r.trip_distance_miles) for r in models["fact_trips"].collect()
    )
    gold = {name: sorted(map(str, models[name].collect())) for name in monthly.MARTS}
    return fact, gold


def test_months_in_order_and_rerun(spark, lake):
    monthly.load_months(spark, lake, ["2024-01"], "one")
    first, _ = state(spark, lake)
    assert [month for month, _, _ in first] == ["2024-01"] * 3
    monthly.load_months(spark, lake, ["2024-02"], "two")
    fact, gold = state(spark, lake)
    assert [month for month, _, _ in fact] == ["2024-01"] * 2 + ["2024-02"] * 2
    # The trip that moved to February is still in January's marts, the late one in none.
    daily = monthly.models(spark, lake)["mart_daily_demand"].collect()
    assert sorted((str(r.trip_date), r.trip_count) for r in daily) == [("2024-01-01", 2), ("2024-02-05", 1)]

    monthly.load_months(spark, lake, ["2024-02"], "two")
    assert state(spark, lake) == (fact, gold)
    audit = monthly.read_audit(spark, lake).collect()
    assert sorted(r.run_id for r in audit) == ["one-2024-01", "two-2024-02"]
    assert all(r.status == "success" for r in audit)


def test_backfill_equals_the_sequence(spark, lake, tmp_path):
    coverage = monthly.backfill(spark, lake, "2023-12", "2024-02", "fill").collect()
    assert [r.available for r in sorted(coverage)] == [False, True, True]
    together = state(spark, lake)
    sequence = str(tmp_path / "sequence")
    bronze.write_bronze(trips(spark, *JANUARY, *FEBRUARY), monthly.trips_path(sequence))
    bronze.read_zones(spark, monthly.zones_path(lake)).write.csv(monthly.zones_path(sequence), header=True)
    for month in ("2024-01", "2024-02"):
        monthly.load_months(spark, sequence, [month], "s")
    assert state(spark, sequence) == together
    # Loading January once more takes its trip back.
    monthly.load_months(spark, lake, ["2024-01"], "again")
    fact, _ = state(spark, lake)
    assert [month for month, _, _ in fact] == ["2024-01"] * 3 + ["2024-02"]


def test_month_that_loses_its_last_trip_is_removed(spark, tmp_path):
    root = str(tmp_path / "lake")
    bronze.write_bronze(trips(spark, {}, {"file_month": "2024-02"}), monthly.trips_path(root))
    zones = spark.createDataFrame([("100", "Q", "A", "B")], "LocationID string, Borough string, Zone string, service_zone string")
    zones.write.csv(monthly.zones_path(root), header=True)
    monthly.load_months(spark, root, ["2024-01"], "one")
    monthly.load_months(spark, root, ["2024-02"], "two")
    fact = monthly.models(spark, root)["fact_trips"].collect()
    assert [r.dataset_month for r in fact] == ["2024-02"]
    held = snapshots.table_sizes(spark, root).where("table_name = 'fact_trips'").collect()
    assert [(r.partition, r.rows) for r in held] == [("2024-02", 1)]


def test_failed_gate_records_and_raises(spark, lake):
    monthly.load_months(spark, lake, ["2024-01"], "one")
    before = state(spark, lake)
    bad = [{"VendorID": n, "trip_distance": -1.0} for n in range(5)]
    bronze.write_bronze(trips(spark, *JANUARY, *bad), monthly.trips_path(lake))
    with pytest.raises(monthly.GateError, match="2024-01"):
        monthly.load_months(spark, lake, ["2024-01"], "bad")
    assert state(spark, lake) == before
    audit = {r.run_id: r.status for r in monthly.read_audit(spark, lake).collect()}
    assert audit == {"one-2024-01": "success", "bad-2024-01": "failed"}


def test_failed_gate_keeps_the_old_quarantine_and_leaves_no_work_folder(spark, lake):
    monthly.load_months(spark, lake, ["2024-01"], "one")
    bad = [{"VendorID": n, "trip_distance": -1.0} for n in range(5)]
    bronze.write_bronze(trips(spark, *JANUARY, *bad), monthly.trips_path(lake))
    with pytest.raises(monthly.GateError):
        monthly.load_months(spark, lake, ["2024-01"], "bad")
    assert monthly.models(spark, lake)["silver_quarantine"].count() == 0
    assert not list((Path(lake) / "_work").glob("*"))


def test_only_the_month_with_a_broken_contract_is_refused(spark, lake):
    broken = trips(spark, *FEBRUARY).drop("tip_amount", "payment_type")
    bronze.write_bronze(broken, monthly.trips_path(lake))
    for load in (
        lambda: monthly.backfill(spark, lake, "2024-01", "2024-02", "fill"),
        lambda: monthly.load_months(spark, lake, ["2024-02"], "alone"),
        lambda: monthly.load_months(spark, lake, ["2024-01", "2024-02"], "both"),
    ):
        with pytest.raises(bronze.ContractError, match="2024-02.*payment_type,tip_amount"):
            load()
    assert {r.dataset_month for r in monthly.models(spark, lake)["fact_trips"].collect()} == {"2024-01"}


def test_a_column_only_one_month_has_is_null_elsewhere(spark, lake):
    extra = trips(spark, *FEBRUARY).withColumnRenamed("congestion_surcharge", "unknown_fee")
    bronze.write_bronze(extra, monthly.trips_path(lake))
    monthly.backfill(spark, lake, "2024-01", "2024-02", "fill")
    assert {r.dataset_month for r in monthly.models(spark, lake)["fact_trips"].collect()} == {"2024-01", "2024-02"}


def test_stale_run_fails_the_gate(spark, lake):
    with pytest.raises(monthly.GateError):
        monthly.load_months(spark, lake, ["2024-01"], "old", datetime.now(UTC) - timedelta(hours=25))


def test_exports_and_checks_on_stored_models(spark, lake, tmp_path):
    monthly.backfill(spark, lake, "2024-01", "2024-02", "fill")
    models = monthly.models(spark, lake)
    assert {r.failures for r in checks.check_unique(models).collect()} == {0}
    assert {r.failures for r in checks.check_relationships(models["fact_trips"], models["dim_zone"]).collect()} == {0}
    assert dashboards.kpi_latest_day(models["mart_daily_demand"]).first().trip_count == 1
    assert maintenance.warehouse_inspect(models["fact_trips"]).count() == 2
    # A quarantined trip makes every exported model non-empty.
    bronze.write_bronze(
        trips(spark, *FEBRUARY, *({**FEBRUARY[1], "VendorID": n} for n in range(3, 40)), {"file_month": "2024-02", "trip_distance": -1.0, "VendorID": 9}),
        monthly.trips_path(lake),
    )
    monthly.load_months(spark, lake, ["2024-02"], "more")
    destination = str(tmp_path / "export")
    records = {r.model: r.rows for r in monthly.export_month(spark, lake, destination, "2024-02").collect()}
    assert records["silver_quarantine"] == 1 and records["dim_zone"] == 2
    assert records["mart_daily_demand"] == 1 and set(records) == set(publish.EXPORTS)
    assert spark.read.json(f"{destination}/manifests").count() == 2


def test_boundary_cleanup_drops_stray_partitions(spark, lake):
    monthly.backfill(spark, lake, "2024-01", "2024-02", "fill")
    models = monthly.models(spark, lake)
    stray = models["mart_daily_demand"].selectExpr("DATE '2024-03-01' AS trip_date", "* EXCEPT (trip_date)").limit(1)
    with snapshots.Commit(spark, lake) as commit:
        placed = publish.with_month("mart_daily_demand", stray)
        commit.write("mart_daily_demand", placed, "dataset_month", ["2024-03"])
        commit.publish()
    report = {r.model: r.deleted_rows for r in monthly.clean_boundaries(spark, lake).collect()}
    assert report == {"mart_daily_demand": 1, "mart_zone_performance": 0}
    dates = [str(r.trip_date) for r in monthly.models(spark, lake)["mart_daily_demand"].collect()]
    assert "2024-03-01" not in dates and len(dates) == 2


STEPS = ("stage", "put", "publish")


def test_a_load_lost_at_any_write_leaves_the_old_state(spark, lake, monkeypatch):
    """The n-th write of a load (data, manifest entry, version) never happens; the last of them is the version."""
    monthly.load_months(spark, lake, ["2024-01"], "one")
    before, done = state(spark, lake), []

    class Lost(RuntimeError):
        pass

    for at in (0, 3, 5, 7, 10, 13, 15, 16):
        with monkeypatch.context() as patch:
            done.clear()
            for name in STEPS:

                def step(self, *args, _name=name, _real=getattr(snapshots.Commit, name), **kwargs):
                    done.append(_name)
                    if len(done) > at:
                        raise Lost
                    return _real(self, *args, **kwargs)

                patch.setattr(snapshots.Commit, name, step)
            with pytest.raises(Lost):
                monthly.load_months(spark, lake, ["2024-02"], "two")
        assert snapshots.current(spark, lake) == 1
    assert done[-1] == "publish"
    assert state(spark, lake) == before
    assert {r.run_id for r in monthly.read_audit(spark, lake).collect()} == {"one-2024-01"}


def test_versions_stay_readable_and_a_lost_load_can_be_repeated(spark, lake, monkeypatch):
    monthly.load_months(spark, lake, ["2024-01"], "one")
    first = state(spark, lake)
    with monkeypatch.context() as patch:
        patch.setattr(snapshots.lake, "rename_new", lambda *_: False)
        with pytest.raises(snapshots.ConflictError):
            monthly.load_months(spark, lake, ["2024-02"], "two")
    assert state(spark, lake) == first
    monthly.load_months(spark, lake, ["2024-02"], "two")
    second = state(spark, lake)
    assert second != first and snapshots.versions(spark, lake) == [1, 2]
    old = monthly.models(spark, lake, version=1)
    assert sorted((r.dataset_month, r.trip_id, r.trip_distance_miles) for r in old["fact_trips"].collect()) == first[0]
    assert snapshots.damaged(spark, lake).count() == 0
    assert snapshots.expire(spark, lake, keep=1) == [1]
    assert state(spark, lake) == second


def test_an_export_opens_the_files_of_its_month_alone(spark, lake):
    monthly.backfill(spark, lake, "2024-01", "2024-02", "fill")
    for model, df in monthly.models(spark, lake, ["2024-02"]).items():
        files = df.inputFiles()
        assert files and all("dataset_month=2024-02" in f for f in files if model != "dim_zone")


def test_a_column_dropped_by_a_load_stays_dropped(spark, lake):
    monthly.load_months(spark, lake, ["2024-01"], "one")
    with snapshots.Commit(spark, lake) as commit:
        narrow = commit.read(monthly.FACT).drop("rate_code_id")
        commit.write(monthly.FACT, narrow.where("false"), "dataset_month", [])
        commit.publish()
    fact = monthly.models(spark, lake)["fact_trips"]
    assert "rate_code_id" not in fact.columns and fact.count() == 3
