"""Plain SQL for the catalog's queries, for an independent engine to run.

Each query names the relations it needs; they are put in front as WITH clauses.
Instants are naive UTC timestamps here, and results use the catalog's portable
types.
"""

from __future__ import annotations

from tripmill.catalog import (
    BOUNDED_EVENTS,
    COVERAGE_RANGE,
    RELOADED_MONTH,
    VALIDATED_YEAR,
)

RELATIONS = {
    "picked": """
        SELECT *, l_shipdate + to_seconds((l_orderkey * 7919 + l_partkey * 31 + l_linenumber) % 86400) AS pk
        FROM lineitem""",
    "copies": """
        SELECT *, 0 AS copy FROM picked
        UNION ALL SELECT *, 1 FROM picked WHERE l_orderkey % 53 = 0
        UNION ALL SELECT *, 2 FROM picked WHERE l_orderkey % 101 = 0""",
    "trips_raw": """
        SELECT l_linenumber % 2 + 1 AS VendorID,
               pk AS tpep_pickup_datetime,
               CASE WHEN l_partkey % 499 = 7 THEN NULL
                    WHEN l_partkey % 211 = 3 THEN pk
                    ELSE pk + to_seconds(CAST(l_quantity AS BIGINT) * 290 + l_suppkey % 60)
               END AS tpep_dropoff_datetime,
               CASE WHEN l_partkey % 13 = 5 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count,
               CASE WHEN l_partkey % 307 = 11 THEN -1.0::DOUBLE ELSE l_quantity * 0.4::DOUBLE END
                 + CASE WHEN copy = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS trip_distance,
               1.0::DOUBLE AS RatecodeID,
               CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
               CASE WHEN l_partkey % 401 = 13 THEN NULL ELSE CAST(l_partkey % 25 AS INTEGER) END AS PULocationID,
               CAST(l_suppkey % 25 AS INTEGER) AS DOLocationID,
               l_linenumber % 4 + 1 AS payment_type,
               round(l_extendedprice / 110, 2) AS fare_amount,
               round(l_extendedprice * l_discount / 110, 2) AS tip_amount,
               round(l_extendedprice / 110, 2) + round(l_extendedprice * l_discount / 110, 2) + 2.0::DOUBLE
                 AS total_amount,
               strftime(CASE WHEN copy = 2 THEN CAST(pk AS DATE) + INTERVAL 1 MONTH ELSE pk END, '%Y-%m')
                 AS file_month
        FROM copies""",
    "zones_raw": """
        SELECT CAST(n_nationkey AS VARCHAR) AS LocationID, r_name AS Borough, n_name AS Zone,
               'zone ' || CAST(r_regionkey AS VARCHAR) AS service_zone
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "stg_trips": """
        SELECT file_month AS dataset_month,
               CAST(VendorID AS INTEGER) AS vendor_id,
               timezone('UTC', timezone('America/New_York', tpep_pickup_datetime)) AS pickup_at,
               timezone('UTC', timezone('America/New_York', tpep_dropoff_datetime)) AS dropoff_at,
               CAST(passenger_count AS INTEGER) AS passenger_count,
               CAST(trip_distance AS DOUBLE) AS trip_distance_miles,
               CAST(RatecodeID AS INTEGER) AS rate_code_id,
               CAST(store_and_fwd_flag AS VARCHAR) AS store_and_forward_flag,
               CAST(PULocationID AS INTEGER) AS pickup_zone_id,
               CAST(DOLocationID AS INTEGER) AS dropoff_zone_id,
               CAST(payment_type AS INTEGER) AS payment_type_id,
               CAST(fare_amount AS DECIMAL(18, 2)) AS fare_amount,
               CAST(0.5 AS DECIMAL(18, 2)) AS extra_amount,
               CAST(0.5 AS DECIMAL(18, 2)) AS mta_tax_amount,
               CAST(tip_amount AS DECIMAL(18, 2)) AS tip_amount,
               CAST(0.0 AS DECIMAL(18, 2)) AS tolls_amount,
               CAST(1.0 AS DECIMAL(18, 2)) AS improvement_surcharge_amount,
               CAST(total_amount AS DECIMAL(18, 2)) AS total_amount,
               CAST(0.0 AS DECIMAL(18, 2)) AS congestion_surcharge_amount
        FROM trips_raw""",
    "dim_zone": """
        SELECT DISTINCT CAST(LocationID AS INTEGER) AS zone_id, Borough AS borough, Zone AS zone_name, service_zone
        FROM zones_raw WHERE LocationID IS NOT NULL""",
    "timed": "SELECT *, epoch(dropoff_at - pickup_at)::BIGINT AS seconds FROM stg_trips",
    "identified": """
        -- Fixed values: the order of the identity's parts and their separator.
        SELECT sha256(concat_ws('|', coalesce(vendor_id::VARCHAR, ''), coalesce(pickup_at::VARCHAR || '+00', ''),
                                coalesce(dropoff_at::VARCHAR || '+00', ''), coalesce(pickup_zone_id::VARCHAR, ''),
                                coalesce(dropoff_zone_id::VARCHAR, ''), coalesce(total_amount::VARCHAR, ''))) AS trip_id,
               *,
               seconds / 60.0::DOUBLE AS duration_minutes,
               CASE WHEN seconds > 0 THEN trip_distance_miles / (seconds / 3600.0::DOUBLE) END AS average_speed_mph
        FROM timed""",
    "scored": """
        SELECT *, coalesce(
            if(pickup_at IS NULL OR dropoff_at IS NULL, 'missing_timestamp', NULL),
            if(seconds <= 0, 'invalid_duration', NULL),
            if(seconds > 240 * 60, 'duration_out_of_range', NULL),
            if(trip_distance_miles NOT BETWEEN 0 AND 200, 'distance_out_of_range', NULL),
            if(total_amount NOT BETWEEN 0 AND 1000, 'amount_out_of_range', NULL),
            if(pickup_zone_id IS NULL OR dropoff_zone_id IS NULL, 'missing_zone', NULL),
            'accepted') AS quality_status
        FROM identified""",
    "events_silver": """
        SELECT * FROM scored
        QUALIFY row_number() OVER (
            PARTITION BY dataset_month, trip_id
            ORDER BY trip_distance_miles ASC NULLS LAST, passenger_count ASC NULLS LAST,
                     fare_amount ASC NULLS LAST, tip_amount ASC NULLS LAST,
                     payment_type_id ASC NULLS LAST, rate_code_id ASC NULLS LAST,
                     store_and_forward_flag ASC NULLS LAST) = 1""",
    "facts_by_load": "SELECT * FROM events_silver WHERE quality_status = 'accepted'",
    "fact_trips": """
        SELECT f.* FROM facts_by_load f
        JOIN (SELECT trip_id, max(dataset_month) AS dataset_month FROM facts_by_load GROUP BY trip_id)
        USING (trip_id, dataset_month)""",
    "guarded": "SELECT * FROM facts_by_load WHERE strftime(pickup_at, '%Y-%m') = dataset_month",
    "final_guarded": "SELECT * FROM fact_trips WHERE strftime(pickup_at, '%Y-%m') = dataset_month",
    "reloaded": f"SELECT * FROM facts_by_load WHERE dataset_month = '{RELOADED_MONTH}'",
    "merged": f"""
        SELECT *, false AS is_new FROM fact_trips
        WHERE dataset_month <> '{RELOADED_MONTH}' AND trip_id NOT IN (SELECT trip_id FROM reloaded)
        UNION ALL SELECT *, true FROM reloaded""",
    "trip_events": """
        SELECT event_id, ts AS tpep_pickup_datetime, CAST(user_id % 25 AS INTEGER) AS PULocationID,
               1.0::DOUBLE AS passenger_count, value / 3.0::DOUBLE AS trip_distance, value AS total_amount
        FROM events""",
    "runs_raw": """
        SELECT 'run-' || file_month AS run_id, file_month AS dataset_month,
               CASE WHEN file_month LIKE '%-07' THEN 'failed' ELSE 'success' END AS status,
               count(*) AS bronze_rows,
               CAST(file_month || '-01' AS DATE) + INTERVAL 1 MONTH + INTERVAL 330 MINUTE AS started_at,
               CAST(file_month || '-01' AS DATE) + INTERVAL 1 MONTH + INTERVAL 360 MINUTE AS completed_at
        FROM trips_raw GROUP BY file_month""",
    "zone_files": """
        SELECT Borough AS borough, strlen(body) AS bytes, sha256(body) AS sha256
        FROM (SELECT Borough,
                     string_agg(LocationID || ',' || Borough || ',' || Zone || ',' || service_zone, chr(10)
                                ORDER BY CAST(LocationID AS INTEGER)) || chr(10) AS body
              FROM zones_raw GROUP BY Borough)""",
    "counted": """
        SELECT dataset_month,
               CAST(count(*) FILTER (WHERE quality_status = 'accepted') AS BIGINT) AS silver_rows,
               CAST(count(*) FILTER (WHERE quality_status <> 'accepted') AS BIGINT) AS rejected_rows
        FROM events_silver GROUP BY dataset_month""",
    "audit": """
        SELECT run_id, dataset_month, status, bronze_rows, silver_rows, rejected_rows, started_at, completed_at,
               round(100.0 * rejected_rows / greatest(bronze_rows, 1), 4) AS rejected_rate_pct,
               '{"run_id":"' || run_id || '","bronze_rows":' || bronze_rows || '}' AS details
        FROM runs_raw JOIN counted USING (dataset_month)""",
}


# Exact sums of floating columns: decimals of eight places; means are taken from them.
DISTANCE = "CAST(sum(CAST(trip_distance_miles AS DECIMAL(28, 8))) AS DOUBLE)"
SPEED = "CAST(sum(CAST(average_speed_mph AS DECIMAL(28, 8))) AS DOUBLE) / count(average_speed_mph)"
MINUTES = "round(sum(seconds) / (60.0::DOUBLE * count(seconds)), 2)"


def _daily(source: str) -> str:
    return f"""
        SELECT pickup_at::DATE AS trip_date, count(*) AS trip_count,
               CAST(sum(ifnull(passenger_count, 0)) AS BIGINT) AS passenger_count,
               round({DISTANCE}, 2) AS distance_miles, sum(total_amount)::DOUBLE AS revenue_amount,
               round(avg(fare_amount), 2) AS average_fare_amount, {MINUTES} AS average_duration_minutes,
               round(100.0 * count(*) FILTER (WHERE tip_amount > 0) / count(*), 2) AS tip_rate_pct
        FROM {source} GROUP BY ALL"""


def _zone(source: str) -> str:
    return f"""
        SELECT * EXCLUDE (pickup_zone_id, service_zone, zone_id), pickup_zone_id AS zone_id
        FROM (SELECT pickup_at::DATE AS trip_date, pickup_zone_id, count(*) AS trip_count,
                     sum(total_amount)::DOUBLE AS revenue_amount, round(avg(fare_amount), 2) AS average_fare_amount,
                     {MINUTES} AS average_duration_minutes, round({SPEED}, 2) AS average_speed_mph
              FROM {source} GROUP BY ALL) LEFT JOIN dim_zone ON zone_id = pickup_zone_id"""


def _minutes(source: str) -> str:
    return f"""
        SELECT CAST(date_trunc('minute', tpep_pickup_datetime) AS VARCHAR) AS event_minute,
               CAST(PULocationID AS BIGINT) AS pickup_zone_id, count(*) AS trip_count,
               CAST(sum(CAST(total_amount AS DECIMAL(28, 8))) AS DOUBLE) AS revenue_amount
        FROM {source} GROUP BY 1, 2"""


RELATIONS["mart_daily_demand"] = _daily("guarded")
RELATIONS["mart_zone_performance"] = _zone("guarded")
RELATIONS["mart_hourly_pattern"] = """
        SELECT strftime(pickup_at, '%Y-%m') AS dataset_month, dayname(pickup_at) AS weekday_name,
               dayofweek(pickup_at) AS weekday_number, hour(pickup_at) AS pickup_hour,
               count(*) AS trip_count,
               round(avg(fare_amount), 2) AS average_fare_amount,
               round(sum(seconds) / (count(seconds) * 60.0::DOUBLE), 2) AS average_duration_minutes,
               round(100.0 * avg(CASE WHEN tip_amount > 0 THEN 1 ELSE 0 END), 2) AS tip_rate_pct
        FROM guarded GROUP BY 1, 2, 3, 4"""

RELATIONS["exported"] = """
        SELECT 'fact_trips' AS model, dataset_month, count(*) AS rows FROM facts_by_load GROUP BY 2
        UNION ALL SELECT 'silver_quarantine', dataset_month, count(*) FROM events_silver
                  WHERE quality_status <> 'accepted' GROUP BY 2
        UNION ALL SELECT 'dim_zone', 'all', count(*) FROM dim_zone
        UNION ALL SELECT 'mart_daily_demand', strftime(trip_date, '%Y-%m'), count(*)
                  FROM mart_daily_demand GROUP BY 2
        UNION ALL SELECT 'mart_zone_performance', strftime(trip_date, '%Y-%m'), count(*)
                  FROM mart_zone_performance GROUP BY 2
        UNION ALL SELECT 'mart_hourly_pattern', dataset_month, count(*) FROM mart_hourly_pattern GROUP BY 2"""

STAGED = """dataset_month, CAST(vendor_id AS BIGINT) AS vendor_id,
    CAST(pickup_at AS VARCHAR) AS pickup_at, CAST(dropoff_at AS VARCHAR) AS dropoff_at,
    CAST(passenger_count AS BIGINT) AS passenger_count, trip_distance_miles,
    CAST(rate_code_id AS BIGINT) AS rate_code_id, store_and_forward_flag,
    CAST(pickup_zone_id AS BIGINT) AS pickup_zone_id, CAST(dropoff_zone_id AS BIGINT) AS dropoff_zone_id,
    CAST(payment_type_id AS BIGINT) AS payment_type_id, CAST(fare_amount AS DOUBLE) AS fare_amount,
    CAST(extra_amount AS DOUBLE) AS extra_amount, CAST(mta_tax_amount AS DOUBLE) AS mta_tax_amount,
    CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount,
    CAST(improvement_surcharge_amount AS DOUBLE) AS improvement_surcharge_amount,
    CAST(total_amount AS DOUBLE) AS total_amount,
    CAST(congestion_surcharge_amount AS DOUBLE) AS congestion_surcharge_amount"""
SCORED = f"trip_id, {STAGED}, duration_minutes, average_speed_mph, quality_status"
FACT = """trip_id, dataset_month, CAST(pickup_at AS VARCHAR) AS pickup_at, trip_distance_miles,
    CAST(total_amount AS DOUBLE) AS total_amount, quality_status"""
DAILY = "* REPLACE (CAST(trip_date AS VARCHAR) AS trip_date)"
HOURLY_KEYS = "CAST(weekday_number AS BIGINT) AS weekday_number, CAST(pickup_hour AS BIGINT) AS pickup_hour"


def _result(model: str, column: str, check: str, failures: str, severity: str = "error") -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{check}' AS check_name, "
        f"'{severity}' AS severity, CAST(({failures}) AS BIGINT) AS failures"
    )


def _nulls(model: str, relation: str, columns: list[str]) -> list[str]:
    severity = "warn" if model == "stg_trips" else "error"
    return [
        _result(model, name, "not_null", f"SELECT count(*) FROM {relation} WHERE {name} IS NULL", severity)
        for name in columns
    ]


def _repeats(model: str, relation: str, key: str, grain: str | None = None) -> str:
    return _result(
        model,
        key,
        "unique",
        f"SELECT count(*) FROM (SELECT 1 FROM {relation} WHERE {key} IS NOT NULL "
        f"GROUP BY {grain or key} HAVING count(*) > 1)",
    )


def _orphans(column: str) -> str:
    return _result(
        "fact_trips",
        column,
        "relationships",
        f"SELECT count(*) FROM fact_trips WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT zone_id FROM dim_zone)",
    )


_FIRST, _LAST = COVERAGE_RANGE

BODIES = {
    "stg_trips": f"SELECT {STAGED} FROM stg_trips",
    "stg_zones": """
        SELECT CAST(LocationID AS BIGINT) AS zone_id, Borough AS borough, Zone AS zone_name, service_zone
        FROM zones_raw""",
    "bronze_contract": """
        SELECT file_month AS dataset_month, count(*) AS row_count, CAST(19 AS BIGINT) AS column_count,
               '' AS missing_columns, CAST(0 AS BIGINT) AS refused_files, true AS accepted
        FROM trips_raw GROUP BY 1""",
    "bronze_contract_per_file": f"""
        SELECT file_month AS dataset_month, count(*) AS row_count,
               if(file_month = '{RELOADED_MONTH}' AND bool_or(VendorID = 2), 'payment_type,tip_amount', '')
                 AS missing_columns,
               NOT (file_month = '{RELOADED_MONTH}' AND bool_or(VendorID = 2)) AS accepted
        FROM trips_raw GROUP BY 1""",
    "footer_profile": """
        SELECT file_month AS dataset_month, count(*) AS row_count,
               CAST(min(tpep_pickup_datetime) AS VARCHAR) AS first_pickup,
               CAST(max(tpep_pickup_datetime) AS VARCHAR) AS last_pickup,
               count(*) FILTER (WHERE tpep_dropoff_datetime IS NULL) AS missing_dropoffs,
               count(*) FILTER (WHERE PULocationID IS NULL) AS missing_pickup_zones,
               min(total_amount) AS least_amount, max(total_amount) AS greatest_amount
        FROM trips_raw GROUP BY 1""",
    "snapshot_versions": f"""
        , versions AS (
            SELECT 1 AS version, 'fact_trips' AS table_name, dataset_month, total_amount FROM fact_trips
            UNION ALL SELECT 2, 'fact_trips', dataset_month, total_amount FROM merged
            UNION ALL SELECT 1, 'mart_daily_demand', strftime(trip_date, '%Y-%m'), CAST(revenue_amount AS DECIMAL(18, 2))
                      FROM ({_daily("final_guarded")})
            UNION ALL SELECT 2, 'mart_daily_demand', strftime(trip_date, '%Y-%m'), CAST(revenue_amount AS DECIMAL(18, 2))
                      FROM ({_daily("final_guarded")}) WHERE strftime(trip_date, '%Y-%m') <> '{RELOADED_MONTH}'
            UNION ALL SELECT 2, 'mart_daily_demand', '{RELOADED_MONTH}', CAST(revenue_amount AS DECIMAL(18, 2))
                      FROM mart_daily_demand WHERE strftime(trip_date, '%Y-%m') = '{RELOADED_MONTH}')
        SELECT CAST(version AS BIGINT) AS version, table_name, dataset_month, count(*) AS rows,
               CAST(sum(total_amount) AS DOUBLE) AS amount
        FROM versions GROUP BY ALL""",
    "snapshot_sizes": f"""
        SELECT 'fact_trips' AS table_name, dataset_month AS partition, count(*) AS rows FROM merged GROUP BY 2
        UNION ALL
        SELECT 'mart_daily_demand', strftime(trip_date, '%Y-%m'), count(*) FROM ({_daily("final_guarded")})
        WHERE strftime(trip_date, '%Y-%m') <> '{RELOADED_MONTH}' GROUP BY 2
        UNION ALL
        SELECT 'mart_daily_demand', '{RELOADED_MONTH}', count(*) FROM mart_daily_demand
        WHERE strftime(trip_date, '%Y-%m') = '{RELOADED_MONTH}'""",
    "file_checksums": "SELECT borough, bytes, sha256 FROM zone_files",
    "changed_files": "SELECT borough, bytes, sha256 FROM zone_files WHERE borough IN ('ASIA', 'EUROPE')",
    "bronze_manifest": """
        SELECT 'yellow_trips' AS dataset, file_month AS dataset_month, 'ready' AS status,
               'VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,RatecodeID,'
               || 'store_and_fwd_flag,PULocationID,DOLocationID,payment_type,fare_amount,extra,mta_tax,tip_amount,'
               || 'tolls_amount,improvement_surcharge,total_amount,congestion_surcharge,file_month' AS columns,
               count(*) AS rows, true AS complete
        FROM trips_raw GROUP BY 2""",
    "bronze_partitioned_scan": """
        SELECT file_month[1:4] AS year, file_month[6:7] AS month, count(*) AS trips,
               CAST(min(tpep_pickup_datetime) AS VARCHAR) AS first_pickup,
               CAST(max(tpep_pickup_datetime) AS VARCHAR) AS last_pickup
        FROM trips_raw GROUP BY 1, 2""",
    "trip_id": """
        SELECT trip_id, CAST(pickup_at AS VARCHAR) || '+00' AS pickup_text,
               CAST(dropoff_at AS VARCHAR) || '+00' AS dropoff_text
        FROM identified""",
    "trip_measures": """
        SELECT dataset_month, CAST(pickup_at AS VARCHAR) AS pickup_at, CAST(dropoff_at AS VARCHAR) AS dropoff_at,
               duration_minutes, average_speed_mph
        FROM identified""",
    "quality_status": "SELECT dataset_month, quality_status, count(*) AS trips FROM scored GROUP BY 1, 2",
    "silver_trip_events": f"SELECT {SCORED} FROM events_silver",
    "silver_quarantine": f"SELECT {SCORED} FROM events_silver WHERE quality_status <> 'accepted'",
    "fact_trips": f"SELECT {SCORED} FROM facts_by_load",
    "silver_trips_view": """
        SELECT trip_id, dataset_month, CAST(pickup_at AS VARCHAR) AS pickup_at,
               CAST(total_amount AS DOUBLE) AS total_amount, quality_status
        FROM fact_trips""",
    "dim_zone": "SELECT CAST(zone_id AS BIGINT) AS zone_id, borough, zone_name, service_zone FROM dim_zone",
    "scalar_calendar": """
        SELECT CAST(pickup_at AS VARCHAR) AS pickup_at, strftime(pickup_at, '%Y-%m') AS month,
               dayname(pickup_at) AS weekday_name, CAST(dayofweek(pickup_at) AS BIGINT) AS weekday_number,
               CAST(hour(pickup_at) AS BIGINT) AS hour
        FROM stg_trips""",
    "mart_daily_demand": f"SELECT {DAILY} FROM mart_daily_demand",
    "mart_zone_performance": """
        SELECT * REPLACE (CAST(trip_date AS VARCHAR) AS trip_date, CAST(zone_id AS BIGINT) AS zone_id)
        FROM mart_zone_performance""",
    "mart_hourly_pattern": f"""
        SELECT dataset_month, weekday_name, {HOURLY_KEYS}, trip_count, average_fare_amount,
               average_duration_minutes, tip_rate_pct
        FROM mart_hourly_pattern""",
    "month_guard": """
        SELECT dataset_month, count(*) AS fact_rows,
               count(*) FILTER (WHERE strftime(pickup_at, '%Y-%m') = dataset_month) AS guarded_rows,
               count(*) FILTER (WHERE strftime(pickup_at, '%Y-%m') <> dataset_month) AS boundary_rows
        FROM facts_by_load GROUP BY 1""",
    "daily_summary_local": """
        SELECT CAST(CAST(tpep_pickup_datetime AS DATE) AS VARCHAR) AS trip_date, count(*) AS trip_count,
               round(CAST(sum(CAST(total_amount AS DECIMAL(28, 8))) AS DOUBLE), 2) AS revenue_amount,
               round(CAST(sum(CAST(trip_distance AS DECIMAL(28, 8))) AS DOUBLE) / count(trip_distance), 2)
                 AS average_distance_miles
        FROM trips_raw GROUP BY 1 ORDER BY 1""",
    "backfill_range": f"SELECT {FACT} FROM fact_trips",
    "backfill_shared_hours": f"SELECT {FACT} FROM fact_trips",
    "contested_by_sketch": f"""
        SELECT dataset_month, count(*) AS trips FROM fact_trips
        WHERE dataset_month <> '{RELOADED_MONTH}'
          AND trip_id IN (SELECT trip_id FROM facts_by_load WHERE dataset_month = '{RELOADED_MONTH}')
        GROUP BY dataset_month""",
    "fact_incremental_merge": f"SELECT {FACT} FROM merged",
    "schema_sync_merge": """
        SELECT trip_id, dataset_month,
               CASE WHEN is_new THEN CAST(congestion_surcharge_amount AS DOUBLE) END AS congestion_surcharge_amount,
               CAST(24 AS BIGINT) AS column_count
        FROM merged""",
    "gold_month_replace": f"""
        SELECT {DAILY} FROM ({_daily("final_guarded")})
        WHERE strftime(trip_date, '%Y-%m') <> '{RELOADED_MONTH}'
        UNION ALL
        SELECT {DAILY} FROM mart_daily_demand WHERE strftime(trip_date, '%Y-%m') = '{RELOADED_MONTH}'""",
    "export_month_slice": """
        SELECT trip_id, dataset_month[1:4] AS year, dataset_month[6:7] AS month,
               CAST(total_amount AS DOUBLE) AS total_amount
        FROM facts_by_load""",
    "export_counts": "SELECT * FROM exported",
    "publish_manifest": """
        SELECT run_id, dataset_month, status, bronze_rows, silver_rows, rejected_rows,
               completed_at - started_at <= INTERVAL 24 HOUR AS freshness_sla_met,
               model, rows, if(model IS NULL, NULL, true) AS verifiable
        FROM audit LEFT JOIN exported USING (dataset_month)""",
    "run_metrics": """
        SELECT dataset_month, bronze_rows, silver_rows, rejected_rows, rejected_rate_pct FROM audit""",
    "freshness_check": """
        SELECT run_id, round(date_diff('microsecond', started_at, completed_at) / 1e6, 3) AS duration_seconds,
               CAST(24 AS BIGINT) AS freshness_sla_hours,
               date_diff('microsecond', started_at, completed_at) <= 86400000000 AS freshness_sla_met
        FROM runs_raw""",
    "quality_gate": """
        SELECT dataset_month, 'bronze_rows_at_least_one' AS expectation,
               CAST(bronze_rows AS DOUBLE) AS observed, bronze_rows >= 1 AS success FROM audit
        UNION ALL SELECT dataset_month, 'silver_rows_at_least_one', silver_rows, silver_rows >= 1 FROM audit
        UNION ALL SELECT dataset_month, 'rejected_rate_within_limit', rejected_rate_pct,
                         rejected_rate_pct BETWEEN 0 AND 5 FROM audit
        UNION ALL SELECT dataset_month, 'freshness_sla_met', 1.0, true FROM audit""",
    "volume_anomaly": """
        SELECT run_id, dataset_month, bronze_rows,
               round(baseline, 2) AS volume_baseline_rows,
               round(100.0 * (bronze_rows - baseline) / baseline, 4) AS volume_deviation_pct,
               coalesce(abs(100.0 * (bronze_rows - baseline) / baseline) > 30, false) AS volume_anomaly_warning
        FROM (SELECT r.*, (SELECT avg(bronze_rows) FROM (
                  SELECT h.bronze_rows FROM runs_raw h
                  WHERE h.status = 'success' AND h.completed_at < r.completed_at
                  ORDER BY h.completed_at DESC LIMIT 7)) AS baseline
              FROM runs_raw r)""",
    "audit_upsert": """
        SELECT run_id, dataset_month, 'success' AS status, bronze_rows, silver_rows, rejected_rows,
               CAST(started_at AS VARCHAR) AS started_at,
               CAST(CASE WHEN status = 'failed' THEN completed_at + INTERVAL 1 DAY ELSE completed_at END AS VARCHAR)
                 AS completed_at,
               CASE WHEN status = 'failed'
                    THEN '{"run_id":"' || run_id || '","status":"success","bronze_rows":' || bronze_rows || '}'
                    ELSE details END AS details
        FROM audit
        UNION ALL
        SELECT 'second-' || dataset_month, dataset_month, status, bronze_rows, silver_rows, rejected_rows,
               CAST(started_at + INTERVAL 1 DAY AS VARCHAR), CAST(completed_at + INTERVAL 1 DAY AS VARCHAR),
               '{"run_id":"second-' || dataset_month || '","status":"' || status || '","bronze_rows":'
                 || bronze_rows || '}'
        FROM audit WHERE dataset_month LIKE '%-12'""",
    "test_not_null": "\nUNION ALL ".join(
        [
            *_nulls("stg_trips", "stg_trips", ["pickup_at", "dropoff_at"]),
            *_nulls("dim_zone", "dim_zone", ["zone_id", "zone_name"]),
            *_nulls("silver_trip_events", "events_silver", ["trip_id"]),
            *_nulls("silver_trips", "fact_trips", ["trip_id"]),
            *_nulls("fact_trips", "fact_trips", ["trip_id", "dataset_month"]),
            *_nulls("mart_daily_demand", "mart_daily_demand", ["trip_date", "trip_count"]),
            *_nulls("mart_zone_performance", "mart_zone_performance", ["trip_date", "zone_id"]),
            *_nulls("mart_hourly_pattern", "mart_hourly_pattern", ["pickup_hour"]),
        ]
    ),
    "test_unique": "\nUNION ALL ".join(
        [
            _repeats("dim_zone", "dim_zone", "zone_id"),
            _repeats("silver_trip_events", "events_silver", "trip_id", "dataset_month, trip_id"),
            _repeats("silver_trips", "fact_trips", "trip_id"),
            _repeats("fact_trips", "fact_trips", "trip_id"),
            _repeats("mart_daily_demand", "mart_daily_demand", "trip_date"),
        ]
    ),
    "test_accepted_values": _result(
        "silver_trip_events",
        "quality_status",
        "accepted_values",
        """SELECT count(DISTINCT quality_status) FROM events_silver WHERE quality_status NOT IN (
           'accepted', 'missing_timestamp', 'invalid_duration', 'duration_out_of_range',
           'distance_out_of_range', 'amount_out_of_range', 'missing_zone')""",
    ),
    "test_relationships": f"{_orphans('pickup_zone_id')}\nUNION ALL {_orphans('dropoff_zone_id')}",
    "test_quarantine_rate": """
        SELECT dataset_month, silver_rows + rejected_rows AS total_rows, rejected_rows,
               rejected_rows / greatest(silver_rows + rejected_rows, 1) AS rejected_share
        FROM counted WHERE rejected_rows / greatest(silver_rows + rejected_rows, 1) > 0.05""",
    "test_gold_grains": """
        SELECT 'mart_zone_performance' AS model, count(*) AS duplicate_grains FROM (
            SELECT 1 FROM mart_zone_performance GROUP BY trip_date, zone_id HAVING count(*) > 1)
        UNION ALL SELECT 'mart_hourly_pattern', count(*) FROM (
            SELECT 1 FROM mart_hourly_pattern GROUP BY dataset_month, weekday_number, pickup_hour
            HAVING count(*) > 1)""",
    "month_coverage": f"""
        SELECT strftime(m, '%Y-%m') AS dataset_month, CAST(year(m) AS BIGINT) AS year,
               CAST(month(m) AS BIGINT) AS month, rows, rows IS NOT NULL AS available
        FROM (SELECT unnest(generate_series(DATE '{_FIRST}-01', DATE '{_LAST}-01', INTERVAL 1 MONTH)) AS m)
        LEFT JOIN (SELECT dataset_month, count(*) AS rows FROM facts_by_load GROUP BY 1) f
          ON f.dataset_month = strftime(m, '%Y-%m')""",
    "boundary_cleanup": f"""
        , loaded AS (SELECT * FROM facts_by_load
                     WHERE dataset_month IN (SELECT dataset_month FROM runs_raw WHERE status = 'success')),
          gold AS (SELECT 'mart_daily_demand' AS model, strftime(trip_date, '%Y-%m') AS m
                   FROM ({_daily("loaded")})
                   UNION ALL SELECT 'mart_zone_performance', strftime(trip_date, '%Y-%m')
                   FROM ({_zone("loaded")})),
          marked AS (SELECT model, m IN (SELECT dataset_month FROM loaded) AS kept FROM gold)
        SELECT model, count(*) AS rows_before, count(*) FILTER (WHERE kept) AS rows_after,
               count(*) FILTER (WHERE NOT kept) AS deleted_rows
        FROM marked GROUP BY 1""",
    "year_validation": f"""
        SELECT CAST({VALIDATED_YEAR} AS BIGINT) AS year, f.*, g.*, true AS pickup_is_instant,
               fact_rows = unique_trips AND months = 12 AS valid
        FROM (SELECT count(*) AS fact_rows, count(DISTINCT trip_id) AS unique_trips,
                     count(DISTINCT dataset_month) AS months,
                     min(dataset_month) AS first_month, max(dataset_month) AS last_month
              FROM fact_trips
              WHERE dataset_month BETWEEN '{VALIDATED_YEAR}-01' AND '{VALIDATED_YEAR}-12') f,
             (SELECT count(*) AS gold_days, CAST(min(trip_date) AS VARCHAR) AS first_gold_date,
                     CAST(max(trip_date) AS VARCHAR) AS last_gold_date
              FROM mart_daily_demand
              WHERE trip_date >= DATE '{VALIDATED_YEAR}-01-01'
                AND trip_date < DATE '{VALIDATED_YEAR + 1}-01-01') g""",
    "warehouse_inspect": """
        SELECT dataset_month, count(*) AS fact_rows, count(DISTINCT trip_id) AS unique_trips,
               true AS pickup_is_instant
        FROM fact_trips GROUP BY 1""",
    "table_counts": """
        SELECT 'daily' AS model, count(*) AS row_count FROM mart_daily_demand
        UNION ALL SELECT 'zone', count(*) FROM mart_zone_performance
        UNION ALL SELECT 'hourly', count(*) FROM mart_hourly_pattern
        UNION ALL SELECT 'audit', count(*) FROM runs_raw""",
    "kpi_latest_day": """
        SELECT CAST(trip_date AS VARCHAR) AS trip_date, trip_count, revenue_amount, average_fare_amount,
               tip_rate_pct
        FROM mart_daily_demand ORDER BY mart_daily_demand.trip_date DESC LIMIT 1""",
    "daily_trend": """
        SELECT CAST(trip_date AS VARCHAR) AS trip_date, trip_count, revenue_amount
        FROM mart_daily_demand ORDER BY 1""",
    "daily_trend_chart": """
        SELECT CAST(CAST(date_trunc('day', trip_date) AS TIMESTAMP) AS VARCHAR) AS day,
               CAST(sum(trip_count) AS BIGINT) AS trips, sum(revenue_amount) AS revenue
        FROM mart_daily_demand GROUP BY 1 ORDER BY 1""",
    "top_zones": """
        SELECT zone_name, borough, CAST(sum(trip_count) AS BIGINT) AS trip_count,
               CAST(sum(CAST(revenue_amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue_amount
        FROM mart_zone_performance GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 20""",
    "zone_table": """
        SELECT zone_name, borough, CAST(sum(trip_count) AS BIGINT) AS trip_count,
               CAST(sum(CAST(revenue_amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue_amount
        FROM mart_zone_performance GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 25""",
    "demand_heatmap": f"""
        SELECT weekday_name, {HOURLY_KEYS}, CAST(sum(trip_count) AS BIGINT) AS trip_count
        FROM mart_hourly_pattern GROUP BY 1, 2, 3 ORDER BY 2, 3""",
    "demand_heatmap_chart": """
        SELECT CAST(pickup_hour AS BIGINT) AS pickup_hour, weekday_name, CAST(sum(trip_count) AS BIGINT) AS trips
        FROM mart_hourly_pattern GROUP BY 1, 2""",
    "kpi_totals": """
        SELECT CAST(sum(trip_count) AS BIGINT) AS trips,
               CAST(sum(CAST(revenue_amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
               round(round(avg(CAST(average_fare_amount AS DECIMAL(18, 2))), 10), 4) AS average_fare,
               round(round(avg(CAST(tip_rate_pct AS DECIMAL(18, 2))), 10), 4) AS tip_rate_pct
        FROM mart_daily_demand""",
    "kpi_rejection_rate": """
        SELECT 100.0::DOUBLE * sum(rejected_rows) / nullif(sum(bronze_rows), 0) AS rejected_pct FROM audit""",
    "quality_panel": """
        SELECT dataset_month, bronze_rows, silver_rows, rejected_rows,
               round(100.0::DOUBLE * rejected_rows / nullif(bronze_rows, 0), 4) AS rejected_rate_pct,
               CAST(completed_at AS VARCHAR) AS completed_at
        FROM audit WHERE status = 'success' ORDER BY audit.completed_at DESC""",
    "replay_events": """
        SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S')
                 || CASE WHEN strftime(tpep_pickup_datetime, '%f') = '000000' THEN ''
                         ELSE strftime(tpep_pickup_datetime, '.%f') END AS tpep_pickup_datetime,
               CAST(PULocationID AS DOUBLE) AS PULocationID, passenger_count, trip_distance, total_amount
        FROM trip_events""",
    "stream_minute_zone": _minutes("trip_events"),
    "stream_minute_zone_watermarked": _minutes("trip_events"),
    "stream_bounded_replay": _minutes(
        f"(SELECT * FROM trip_events ORDER BY event_id LIMIT {BOUNDED_EVENTS})"
    ),
    "stream_rejects": """
        SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS tpep_pickup_datetime,
               trip_distance, total_amount, 'missing_zone' AS reject_reason
        FROM trips_raw WHERE PULocationID IS NULL""",
}

WITH = ",\n".join(f"{name} AS ({sql})" for name, sql in RELATIONS.items())


def statement(body: str) -> str:
    return f"WITH {WITH}\n{body.strip()}"


ORACLES = {name: statement(body) for name, body in BODIES.items()}
