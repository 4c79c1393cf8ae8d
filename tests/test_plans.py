"""What the plans look like, since that is what decides at scale."""

import pytest
from helpers import trips
from pyspark.sql import functions as F

from tripmill import __main__ as cli
from tripmill.catalog import QUERIES, audit_table, warehouse, written_warehouse
from tripmill.operators import facts, maintenance, marts, silver, staging
from tripmill.plans import monthly
from tripmill.sources.lake import read_table, replace_partitions

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Facts on storage, as the monthly load leaves them."""
    path = str(tmp_path_factory.mktemp("stored") / "fact_trips")
    raw = trips(spark, {}, {"file_month": "2024-02", "VendorID": 2})
    events = silver.silver_trip_events(staging.stg_trips(raw, F.col("file_month")))
    replace_partitions(silver.accepted(events), path, ["dataset_month"])
    return path


def test_month_guard_reaches_the_scan(spark, stored):
    text = plan(marts.mart_daily_demand(marts.guarded(read_table(spark, stored), "2024-01")))
    assert "PartitionFilters: [isnotnull(dataset_month" in text
    assert "GreaterThanOrEqual(pickup_at,2024-01-01" in text
    assert "trip_id" not in text.split("ReadSchema")[1]


def test_marts_shuffle_once(spark, stored):
    fact = read_table(spark, stored)
    zones = staging.dim_zone(
        spark.createDataFrame([(1, "b", "z", "s")], "zone_id int, borough string, zone_name string, service_zone string")
    )
    assert plan(marts.mart_daily_demand(fact)).count("Exchange hashpartitioning") == 1
    assert plan(marts.mart_hourly_pattern(fact)).count("Exchange hashpartitioning") == 1
    text = plan(marts.mart_zone_performance(fact, zones))
    # Facts are aggregated below the join.
    assert text.index("Join") < text.index("partial_count")


def test_contested_months_prune_by_pickup_range(spark, stored):
    fact = read_table(spark, stored)
    text = plan(facts.contested_months(fact, fact.where("dataset_month = '2024-02'"), ["2024-02"]))
    assert "GreaterThanOrEqual(pickup_at" in text and "LeftSemi" in text


def test_year_validation_reads_the_facts_once(spark):
    fact = warehouse(spark, SF_DIR).fact_trips
    daily = warehouse(spark, SF_DIR).mart_daily_demand
    alone, both = plan(maintenance.year_validation(fact, daily.limit(0), 1998)), plan(fact)
    assert alone.count("RunningWindowFunction") + alone.count("+- Window ") <= both.count("RunningWindowFunction") + both.count("+- Window ")


def test_dedup_drops_columns_the_mart_does_not_need(spark):
    text = plan(warehouse(spark, SF_DIR).mart_daily_demand)
    assert "sha2" not in text and text.count("WindowGroupLimit") == 2


@pytest.fixture
def no_small_tables(spark):
    """As on large tables: no side is small enough to be broadcast by its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_digest_does_not_travel(spark, stored):
    text = plan(facts.latest_load_wins(read_table(spark, stored)))
    above, below = text.split("Exchange", 1)
    assert "sha2" in above and "sha2" not in below and "trip_id" not in below


def test_a_derived_column_is_computed_where_it_is_written(spark, tmp_path):
    rows = spark.createDataFrame([("stale", "a", 1), ("stale", "b", 2)], "name string, k string, v int")
    replace_partitions(rows, str(tmp_path / "t"), ["k"], derived={"name": F.concat("k", F.col("v").cast("string"))})
    written = read_table(spark, str(tmp_path / "t"))
    assert written.columns == ["name", "v", "k"]
    assert sorted(r.name for r in written.collect()) == ["a1", "b2"]


def test_hours_of_one_month_pass_without_a_shuffle(spark, stored, no_small_tables):
    text = plan(facts.latest_of_shared_hours(read_table(spark, stored)))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2


def test_merged_rows_of_other_days_pass_without_a_shuffle(spark, stored, no_small_tables):
    fact = read_table(spark, stored)
    text = plan(facts.merge_loads(fact, fact.where("dataset_month = '2024-02'"), ["2024-02"]))
    assert text.count("SortMergeJoin") == 1
    assert text.index("BroadcastHashJoin [trip_day") < text.index("SortMergeJoin")


def test_an_audit_over_stored_events_does_not_build_them_again(spark):
    built = written_warehouse(spark, SF_DIR)
    text = plan(audit_table(spark, SF_DIR, built.silver_trip_events))
    assert "Window" not in text and "Window" in plan(audit_table(spark, SF_DIR))


@pytest.mark.parametrize("name", ["silver_trip_events", "mart_zone_performance", "backfill_range", "test_relationships", "run_metrics", "top_zones"])
def test_no_cross_joins_and_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in text


def test_command_line(spark, tmp_path):
    source, root = str(tmp_path / "trips.parquet"), str(tmp_path / "lake")
    trips(spark, {}, {"VendorID": 2}).drop("file_month").write.parquet(source)
    zones = tmp_path / "zones.csv"
    zones.write_text("LocationID,Borough,Zone,service_zone\n100,Q,A,B\n")
    land = cli.parse(["land", "--root", root, "--source", source, "--month", "2024-01", "--zones", str(zones)])
    cli.land(spark, land)
    cli.load(spark, cli.parse(["load", "--root", root, "--month", "2024-01"]))
    assert monthly.models(spark, root)["fact_trips"].count() == 2
    with pytest.raises(SystemExit, match="not valid"):
        cli.validate(spark, cli.parse(["validate", "--root", root, "--year", "2024"]))
    cli.inspect(spark, cli.parse(["inspect", "--root", root]))
    cli.summary(spark, cli.parse(["summary", "--source", source, "--output", str(tmp_path / "s")]))
    assert spark.read.parquet(str(tmp_path / "s")).first().trip_count == 2
    events, checkpoint = str(tmp_path / "events"), str(tmp_path / "cp")
    cli.replay_trips(spark, cli.parse(["replay", "--source", source, "--output", events, "--limit", "1"]))
    cli.minutes(
        spark,
        cli.parse(["minutes", "--source", events, "--output", str(tmp_path / "m"), "--checkpoint", checkpoint, "--state-partitions", "1"]),
    )
    assert cli.stream.read_minute_zone(spark, str(tmp_path / "m" / "minutes")).first().trip_count == 1
