import hashlib
import json
from pathlib import Path

import pytest
from helpers import BASE, trips
from pyspark.sql import functions as F

from tripmill.operators import staging
from tripmill.plans import publish
from tripmill.sources import bronze
from tripmill.sources.lake import drop_partitions, read_table, replace_partitions, shared_root


def test_contract_accepts_a_minimal_file(spark, tmp_path):
    path = str(tmp_path / "trips")
    trips(spark, {}).select(*bronze.REQUIRED_TRIP_COLUMNS).write.parquet(path)
    rows, columns = bronze.require_contract(spark.read.parquet(path))
    assert rows == 1 and set(columns) == set(bronze.REQUIRED_TRIP_COLUMNS)


def test_contract_lists_missing_columns_in_order(spark):
    only_vendor = trips(spark, {}).select("VendorID")
    with pytest.raises(bronze.ContractError, match=r"\['DOLocationID', 'PULocationID', 'fare_amount'"):
        bronze.require_contract(only_vendor)


def test_contract_refuses_an_empty_file(spark):
    with pytest.raises(bronze.ContractError, match="no rows"):
        bronze.require_contract(trips(spark, {}).where("false"))


def test_contract_is_reported_per_landed_month(spark, tmp_path):
    path = str(tmp_path / "trips")
    bronze.write_bronze(trips(spark, {}, {}), path)
    bronze.write_bronze(trips(spark, {"file_month": "2024-02"}).drop("tip_amount", "payment_type"), path)
    trips(spark, {}).where("false").write.parquet(f"{path}/year=2024/month=03")
    found = {r.dataset_month: r for r in bronze.contract_report(spark, path).collect()}
    assert found["2024-01"].accepted and found["2024-01"].row_count == 2
    assert not found["2024-02"].accepted and found["2024-02"].missing_columns == "payment_type,tip_amount"
    assert not found["2024-03"].accepted and found["2024-03"].row_count == 0


@pytest.mark.parametrize("names", [("part-a", "part-b"), ("part-b", "part-a")])
def test_every_file_of_a_month_has_to_meet_the_contract(spark, tmp_path, names):
    path, whole = str(tmp_path / "trips"), trips(spark, *({"VendorID": n} for n in range(5))).toPandas()
    month = tmp_path / "trips/year=2024/month=02"
    month.mkdir(parents=True)
    whole.to_parquet(month / f"{names[0]}.parquet")
    whole.drop(columns=["tip_amount", "payment_type"]).to_parquet(month / f"{names[1]}.parquet")
    found = bronze.contract_report(spark, path).first()
    assert (found.row_count, found.refused_files, found.accepted) == (10, 1, False)
    assert found.missing_columns == "payment_type,tip_amount"
    verdicts = bronze.file_contracts(bronze.trip_footers(spark, path)).collect()
    assert {(Path(r.path).stem, r.accepted) for r in verdicts} == {(names[0], True), (names[1], False)}


def test_footers_of_the_months_asked_for_alone_are_opened(spark, tmp_path):
    path = str(tmp_path / "trips")
    bronze.write_bronze(trips(spark, {}, {"file_month": "2024-02"}), path)
    (tmp_path / "trips/year=2024/month=02/broken.parquet").write_bytes(b"not a footer")
    january = bronze.contract_report(spark, path, ["2024-01"]).collect()
    assert [(r.dataset_month, r.accepted) for r in january] == [("2024-01", True)]
    both = {r.dataset_month: r for r in bronze.contract_report(spark, path).collect()}
    assert not both["2024-02"].accepted and both["2024-02"].unreadable and both["2024-02"].row_count == 1
    assert bronze.contract_report(spark, path, []).count() == 0


def test_files_of_several_layouts_in_one_month(spark, tmp_path):
    path = str(tmp_path / "trips")
    bronze.write_bronze(trips(spark, {}, {"file_month": "2024-02"}), path)
    more = trips(spark, {"VendorID": 2, "file_month": "2024-02"}).withColumnRenamed("congestion_surcharge", "fee")
    more.drop("file_month").write.mode("append").parquet(f"{path}/year=2024/month=02")
    rows = {(r.dataset_month, r.VendorID): r for r in bronze.read_bronze(spark, path).collect()}
    assert set(rows) == {("2024-01", 1), ("2024-02", 1), ("2024-02", 2)}
    assert rows["2024-02", 2].congestion_surcharge is None and rows["2024-02", 2].fee == 0.0
    assert rows["2024-02", 1].congestion_surcharge == 0.0 and rows["2024-01", 1].fee is None


def test_profile_comes_from_footers(spark, tmp_path):
    path = str(tmp_path / "trips")
    bronze.write_bronze(
        trips(spark, {"total_amount": -4.5}, {"tpep_dropoff_datetime": None, "PULocationID": None}, {"total_amount": 99.0}), path
    )
    trips(spark, {}).where("false").write.mode("append").parquet(f"{path}/year=2024/month=01")
    found = bronze.footer_profile(spark, path).first()
    assert (found.row_count, found.missing_dropoffs, found.missing_pickup_zones) == (3, 1, 1)
    assert (found.least_amount, found.greatest_amount) == (-4.5, 99.0)
    assert found.first_pickup == found.last_pickup == BASE["tpep_pickup_datetime"]


def test_layout_and_pruned_month_scan(spark, tmp_path):
    path = str(tmp_path / "trips")
    bronze.write_bronze(trips(spark, {}, {"file_month": "2024-02"}), path)
    assert (Path(path) / "year=2024" / "month=01").is_dir()
    january = bronze.read_bronze(spark, path, ["2024-01"])
    assert [row.dataset_month for row in january.collect()] == ["2024-01"]
    listed = january.inputFiles()
    assert listed and all("month=01" in name for name in listed)
    assert {r.dataset_month for r in bronze.read_bronze(spark, path).collect()} == {"2024-01", "2024-02"}


def test_checksums_match_the_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "BLOCK_BYTES", 1000)  # files of several blocks
    folder = tmp_path / "a blank" / "and +"
    for part in ("x=1", "x=2"):
        (folder / part).mkdir(parents=True)
        (folder / part / "part-000.txt").write_bytes(b"one" * 1500)
    facts = {r.file_key: r for r in bronze.file_facts(spark, str(folder), "*.txt").collect()}
    assert set(facts) == {"x=1/part-000.txt", "x=2/part-000.txt"}
    assert all(r.sha256 == hashlib.sha256(b"one" * 1500).hexdigest() and r.bytes == 4500 for r in facts.values())
    # Equal names and bytes in two folders are two files: one known, one not; then one of them changes.
    known = spark.createDataFrame([facts["x=1/part-000.txt"]], bronze.file_facts(spark, str(folder), "*.txt").schema)
    changed = bronze.changed_files(bronze.file_facts(spark, str(folder), "*.txt"), known)
    assert [r.file_key for r in changed.collect()] == ["x=2/part-000.txt"]
    (folder / "x=1" / "part-000.txt").write_bytes(b"two")
    changed = bronze.changed_files(bronze.file_facts(spark, str(folder), "*.txt"), known)
    assert sorted(r.file_key for r in changed.collect()) == ["x=1/part-000.txt", "x=2/part-000.txt"]


def test_manifest_has_a_row_per_file(spark, tmp_path):
    path, zones = str(tmp_path / "my trips"), tmp_path / "zones"
    bronze.write_bronze(trips(spark, {}, {}, {"file_month": "2024-02"}), path)
    zones.mkdir()
    (zones / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n")
    known = bronze.file_facts(spark, path).where("file_key LIKE '%month=01%'")
    rows = bronze.bronze_manifest(spark, path, str(zones), known).collect()
    assert sorted((str(r.dataset_month), r.rows, r.changed) for r in rows) == [
        ("2024-01", 2, False),
        ("2024-02", 1, True),
        ("None", None, True),
    ]
    assert all(len(r.sha256) == 64 and r.bytes > 0 for r in rows)
    assert all(r.columns.startswith("VendorID,tpep_pickup") for r in rows if r.dataset == bronze.DATASET)


def test_zone_lookup_csv(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text('LocationID,Borough,Zone,service_zone\n1,"EWR","Newark, Airport",EWR\n007,Queens,J,B\n,None,x,y\n')
    raw = bronze.read_zones(spark, str(path))
    assert {kind for _, kind in raw.dtypes} == {"string"}
    zones = staging.dim_zone(staging.stg_zones(raw)).orderBy("zone_id").collect()
    assert [(z.zone_id, z.zone_name) for z in zones] == [(1, "Newark, Airport"), (7, "J")]


def test_replaced_partitions_leave_the_others_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    replace_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path, ["k"])
    replace_partitions(spark.createDataFrame([("b", 3)], "k string, v int"), path, ["k"])
    assert sorted((r.k, r.v) for r in read_table(spark, path).collect()) == [("a", 1), ("b", 3)]
    drop_partitions(spark, path, "k", ["a", "missing"])
    assert [(r.k, r.v) for r in read_table(spark, path).collect()] == [("b", 3)]


def test_shared_root_is_the_configured_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_exports_are_zstd_slices_with_records(spark, tmp_path):
    root = str(tmp_path)
    fact = trips(spark, {}, {"file_month": "2024-02"}).withColumnRenamed("file_month", "dataset_month")
    day = fact.select(F.to_date("tpep_pickup_datetime").alias("trip_date"), F.lit(1).alias("trip_count"))
    models = {
        "fact_trips": fact,
        "silver_quarantine": fact.where("false"),
        "dim_zone": spark.range(3),
        "mart_daily_demand": day,
        "mart_zone_performance": day,
        "mart_hourly_pattern": fact.select("dataset_month"),
    }
    publish.export_models(models, root, "2024-01")
    files = list((tmp_path / "silver/fact_trips/year=2024/month=01").glob("*.parquet"))
    assert files and all(".zstd." in file.name for file in files)
    assert not (tmp_path / "silver/fact_trips/year=2024/month=02").exists()
    records = {r.model: r for r in publish.export_records(spark, root).collect()}
    assert records["dim_zone"].rows == 3 and records["fact_trips"].rows == 1
    # Nothing was quarantined, so there is no slice and no record of it.
    assert "silver_quarantine" not in records
    listed = {r.sha256 for r in publish.export_files(spark, root).collect()}
    assert hashlib.sha256(files[0].read_bytes()).hexdigest() in listed
    assert [f.file_key for f in records["fact_trips"].file_list] == [str(files[0].relative_to(tmp_path))]


def test_manifest_nests_the_records(spark, tmp_path):
    runs = spark.createDataFrame([("run-1", "2024-01")], "run_id string, dataset_month string")
    records = spark.createDataFrame(
        [("b", "2024-01", 1, 1, 9, []), ("a", "2024-01", 2, 1, 9, [("f", 9, "0", True)])],
        "model string, dataset_month string, rows long, files long, bytes long, "
        "file_list array<struct<file_key: string, bytes: long, sha256: string, uploaded: boolean>>",
    )
    publish.write_manifest(publish.publish_manifest(runs, records), str(tmp_path / "m"))
    document = json.loads(spark.read.text(str(tmp_path / "m")).first().value)
    assert [export["model"] for export in document["exports"]] == ["a", "b"]
    assert document["run_id"] == "run-1"


def test_base_trip_has_every_required_column():
    assert set(bronze.REQUIRED_TRIP_COLUMNS) <= set(BASE)
