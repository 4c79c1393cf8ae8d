"""Stand-ins for the landed trip files, built from the generated star-schema tables.

``lineitem`` plays the trips, ``nation`` and ``region`` the zone lookup,
``events`` the live trip stream. Every table is used whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import round_half_away

ZONE_COUNT = 25


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TRIP_EXPRESSIONS = (
    "CAST(l_linenumber % 2 + 1 AS INT) AS VendorID",
    "pickup AS tpep_pickup_datetime",
    """CASE WHEN l_partkey % 499 = 7 THEN NULL WHEN l_partkey % 211 = 3 THEN pickup
       ELSE timestampadd(SECOND, CAST(l_quantity AS BIGINT) * 290 + l_suppkey % 60, pickup)
       END AS tpep_dropoff_datetime""",
    "CASE WHEN l_partkey % 13 != 5 THEN CAST(l_linenumber AS DOUBLE) END AS passenger_count",
    """CASE WHEN l_partkey % 307 = 11 THEN -1D ELSE l_quantity * 0.4D END
       + CASE WHEN copy = 1 THEN 1D ELSE 0D END AS trip_distance""",
    "1D AS RatecodeID",
    "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag",
    f"CASE WHEN l_partkey % 401 != 13 THEN CAST(l_partkey % {ZONE_COUNT} AS INT) END AS PULocationID",
    f"CAST(l_suppkey % {ZONE_COUNT} AS INT) AS DOLocationID",
    "CAST(l_linenumber % 4 + 1 AS INT) AS payment_type",
    "fare_amount",
    "0.5D AS extra",
    "0.5D AS mta_tax",
    "tip_amount",
    "0D AS tolls_amount",
    "1D AS improvement_surcharge",
    "fare_amount + tip_amount + 2D AS total_amount",
    "0D AS congestion_surcharge",
    """date_format(add_months(CAST(pickup AS DATE), CASE WHEN copy = 2 THEN 1 ELSE 0 END), 'yyyy-MM')
       AS file_month""",
)


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips of every landed month, in the column layout of the source files.

    Some trips land twice: once more in the same file with another distance, or
    once more in the file of the following month. One scan emits all copies.
    """
    item = _table(spark, sf_dir, "lineitem")
    return (
        item.withColumns(
            {
                "pickup": F.expr(
                    "timestampadd(SECOND, (l_orderkey * 7919 + l_partkey * 31 + l_linenumber) % 86400, l_shipdate)"
                ),
                "copy": F.expr(
                    "explode(array_compact(array(0, if(l_orderkey % 53 = 0, 1, NULL), if(l_orderkey % 101 = 0, 2, NULL))))"
                ),
                "fare_amount": round_half_away("l_extendedprice / 110D", 2),
                "tip_amount": round_half_away("l_extendedprice * l_discount / 110D", 2),
            }
        )
        .selectExpr(*TRIP_EXPRESSIONS)
    )


def zones_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup as it arrives: every column a string."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        nation.n_nationkey.cast("string").alias("LocationID"),
        region.r_name.alias("Borough"),
        nation.n_name.alias("Zone"),
        F.concat(F.lit("zone "), region.r_regionkey.cast("string")).alias("service_zone"),
    )


def trip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live trips; ``event_id`` gives the replay order."""
    return _table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("user_id") % ZONE_COUNT).cast("int").alias("PULocationID"),
        F.lit(1.0).alias("passenger_count"),
        (F.col("value") / 3.0).alias("trip_distance"),
        F.col("value").alias("total_amount"),
    )


def runs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history: one run per landed month, the July ones failed."""
    completed = F.timestamp_add(
        "HOUR",
        F.lit(6),
        F.add_months(F.to_date(F.concat("file_month", F.lit("-01"))), 1).cast("timestamp"),
    )
    return (
        trips_raw(spark, sf_dir)
        .groupBy("file_month")
        .agg(F.count("*").alias("bronze_rows"))
        .select(
            F.concat(F.lit("run-"), "file_month").alias("run_id"),
            F.col("file_month").alias("dataset_month"),
            F.when(F.col("file_month").endswith("-07"), "failed")
            .otherwise("success")
            .alias("status"),
            "bronze_rows",
            F.timestamp_add("MINUTE", F.lit(-30), completed).alias("started_at"),
            completed.alias("completed_at"),
        )
    )
