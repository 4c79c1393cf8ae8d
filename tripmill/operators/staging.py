"""Typed staging of raw trips and zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions import local_to_instant, to_integer, to_money

# Source column, staged column, staged kind, in output order.
TRIP_CONTRACT = (
    ("VendorID", "vendor_id", "integer"),
    ("tpep_pickup_datetime", "pickup_at", "instant"),
    ("tpep_dropoff_datetime", "dropoff_at", "instant"),
    ("passenger_count", "passenger_count", "integer"),
    ("trip_distance", "trip_distance_miles", "double"),
    ("RatecodeID", "rate_code_id", "integer"),
    ("store_and_fwd_flag", "store_and_forward_flag", "string"),
    ("PULocationID", "pickup_zone_id", "integer"),
    ("DOLocationID", "dropoff_zone_id", "integer"),
    ("payment_type", "payment_type_id", "integer"),
    ("fare_amount", "fare_amount", "money"),
    ("extra", "extra_amount", "money"),
    ("mta_tax", "mta_tax_amount", "money"),
    ("tip_amount", "tip_amount", "money"),
    ("tolls_amount", "tolls_amount", "money"),
    ("improvement_surcharge", "improvement_surcharge_amount", "money"),
    ("total_amount", "total_amount", "money"),
    ("congestion_surcharge", "congestion_surcharge_amount", "money"),
)


def _staged(kind: str, value: str, source: T.DataType) -> Column:
    match kind:
        case "integer":
            return to_integer(value, source)
        case "money":
            return to_money(value, source)
        case "instant":
            return local_to_instant(value)
        case _:
            return F.expr(f"CAST({value} AS {kind})")


def stg_trips(raw: DataFrame, dataset_month: str | Column) -> DataFrame:
    """One typed row per raw row.

    ``dataset_month`` is a literal when one month's file is staged and a column
    when many months are staged together. A source column the file lacks is
    staged as NULL; the columns no file may lack are checked by the contract.
    """
    month = F.lit(dataset_month) if isinstance(dataset_month, str) else dataset_month
    types = {field.name.lower(): field.dataType for field in raw.schema}
    columns = [month.alias("dataset_month")]
    for source, target, kind in TRIP_CONTRACT:
        source_type = types.get(source.lower())
        value = "CAST(NULL AS DOUBLE)" if source_type is None else source
        columns.append(_staged(kind, value, source_type or T.DoubleType()).alias(target))
    return raw.select(*columns, F.current_timestamp().alias("transformed_at"))


def stg_zones(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("LocationID").cast("int").alias("zone_id"),
        F.col("Borough").cast("string").alias("borough"),
        F.col("Zone").cast("string").alias("zone_name"),
        F.col("service_zone").cast("string").alias("service_zone"),
    )


def dim_zone(staged_zones: DataFrame) -> DataFrame:
    return staged_zones.where(F.col("zone_id").isNotNull()).distinct()
