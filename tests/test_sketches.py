from datetime import datetime, timedelta

import pytest
from helpers import trips
from pyspark.sql import functions as F

from tripmill.operators import facts, sketches
from tripmill.plans import monthly
from tripmill.sources import bronze, snapshots

DAY = datetime(2024, 1, 10)
FACTS = "trip_id string, pickup_at timestamp_ntz, dataset_month string"


def some(spark, month, ids, day=DAY):
    return spark.createDataFrame([(f"trip-{i}", day and day + timedelta(seconds=i % 86_400), month) for i in ids], FACTS)


def test_chance_answers_are_as_rare_as_stated(spark):
    held, new = some(spark, "2024-01", range(20_000)), some(spark, "2024-02", range(20_000, 40_000))
    asked = {}
    for bits in (16, 64):
        entries = sketches.key_sketch(new, bits)
        # The load's marks against the stored ones: the share of the load that answers by chance.
        found = sketches.answering(entries, held, ["2024-01"], bits)
        asked[bits] = found.count() / 20_000
    assert asked[64] == 0
    assert asked[16] == pytest.approx(1 - (1 - 2**-16) ** 20_000, abs=0.02)


def test_sketches_lose_no_month_and_only_days_of_the_load_answer(spark, monkeypatch):
    fact = (
        some(spark, "2023-01", range(0, 50))
        .unionByName(some(spark, "2023-02", range(50, 60), day=None))
        .unionByName(some(spark, "2023-03", range(60, 70), day=DAY - timedelta(days=900)))
    )
    new = (
        some(spark, "2024-02", [3, 90, 91])
        .unionByName(some(spark, "2024-02", [55], day=None))
        .unionByName(some(spark, "2024-02", [1000], day=datetime(1970, 1, 1)))
    )
    brute = fact.join(new.select("trip_id"), "trip_id", "left_semi").select("dataset_month").distinct()
    for named in (sketches.NAMED_DAYS, 1):
        monkeypatch.setattr(sketches, "NAMED_DAYS", named)
        for bits in (4, 64):
            got = sketches.answering_months(sketches.key_sketch(fact, bits), new, ["2024-02"], bits)
            months = {r[0] for r in got.collect()}
            assert {r[0] for r in brute.collect()} == {"2023-01", "2023-02"} <= months
            assert "2023-03" not in months  # none of its days is asked, however few the bits
    empty = sketches.key_sketch(fact.limit(0))
    assert sketches.answering_months(empty, new, ["2024-02"]).count() == 0
    assert sketches.answering_months(sketches.key_sketch(fact), new.limit(0), ["2024-02"]).count() == 0
    with pytest.raises(ValueError):
        sketches.key_sketch(fact, 65)


def put(day, month, **more):
    return {"tpep_pickup_datetime": day, "tpep_dropoff_datetime": day + timedelta(minutes=9), "file_month": month, **more}


@pytest.fixture
def lake(spark, tmp_path):
    """Each month has its own trips; April has one of February's again and one with a clock years off."""
    root = str(tmp_path / "lake")
    rows = [put(datetime(2024, m, 5, 8, n), f"2024-{m:02d}") for m in (1, 2, 3, 4) for n in range(3)]
    rows += [put(datetime(2024, 2, 5, 8, 1), "2024-04"), put(datetime(2009, 1, 1), "2024-04")]
    bronze.write_bronze(trips(spark, *rows), monthly.trips_path(root))
    zones = spark.createDataFrame([("100", "Q", "A", "B"), ("200", "B", "C", "D")], "a string, b string, c string, d string")
    zones.toDF("LocationID", "Borough", "Zone", "service_zone").write.csv(monthly.zones_path(root), header=True)
    return root


def test_a_load_reads_only_months_that_answer(spark, lake, monkeypatch):
    for month in ("2024-01", "2024-02", "2024-03"):
        monthly.load_months(spark, lake, [month], month)
    opened, real = [], snapshots.Commit.read

    def noted(self, table, partitions=None):
        if table == monthly.FACT and partitions is not None:
            opened.append(list(partitions))
        return real(self, table, partitions)

    monkeypatch.setattr(snapshots.Commit, "read", noted)
    monthly.load_months(spark, lake, ["2024-04"], "four")
    assert opened == [["2024-02"], ["2024-02"]]
    counts = monthly.stored(spark, lake, monthly.FACT).groupBy("dataset_month").count().collect()
    assert {r[0]: r[1] for r in counts} == {"2024-01": 3, "2024-02": 2, "2024-03": 3, "2024-04": 5}
    fact = monthly.stored(spark, lake, monthly.FACT)
    stored = monthly.stored(spark, lake, monthly.SKETCH)
    rebuilt = sketches.key_sketch(fact)
    assert sorted(stored.select(*rebuilt.columns).collect()) == sorted(rebuilt.collect())


def test_a_month_without_a_sketch_is_read(spark, lake):
    for month in ("2024-02", "2024-03"):
        monthly.load_months(spark, lake, [month], month)
    with snapshots.Commit(spark, lake) as commit:
        commit.put(monthly.SKETCH, commit.read(monthly.SKETCH).schema, monthly.MONTH, ["2024-02"])
        commit.publish()
    monthly.load_months(spark, lake, ["2024-04"], "four")
    counts = monthly.stored(spark, lake, monthly.FACT).groupBy("dataset_month").count().collect()
    assert {r[0]: r[1] for r in counts} == {"2024-02": 2, "2024-03": 3, "2024-04": 5}


def test_shared_hours_give_the_rows_of_the_whole_window(spark):
    names = ("pickup_at", "dropoff_at", "total_amount", "pickup_zone_id", "dropoff_zone_id", "vendor_id")
    rows = [
        (DAY + timedelta(hours=h, minutes=n % 2) if h < 9 else None, None, 1.0, n % 2, None, None, f"2024-{m:02d}", m * 100 + n)
        for m in (1, 2, 3)
        for h in (m, 5, 9)
        for n in range(2)
    ]
    schema = "pickup_at timestamp_ntz, dropoff_at timestamp_ntz, total_amount double, pickup_zone_id int, "
    events = spark.createDataFrame(rows, schema + "dropoff_zone_id int, vendor_id int, dataset_month string, mark int")
    order = [*names, "dataset_month", "mark"]
    got = facts.latest_of_shared_hours(events)
    assert got.columns == events.columns
    assert sorted(map(str, got.select(order).collect())) == sorted(
        map(str, facts.latest_load_wins(events).select(order).collect())
    )
    assert got.count() == 3 * 2 + 2 + 2
    assert facts.latest_of_shared_hours(events.where(F.lit(False))).count() == 0
