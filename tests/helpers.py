"""Hand-written raw trips."""

from datetime import datetime

SCHEMA = (
    "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string, "
    "PULocationID long, DOLocationID long, payment_type long, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double, file_month string"
)
NAMES = [field.split()[0] for field in SCHEMA.split(", ")]
BASE = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2024, 1, 1, 10, 0),
    "tpep_dropoff_datetime": datetime(2024, 1, 1, 10, 15),
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": 1,
    "fare_amount": 12.5,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.5,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 18.0,
    "congestion_surcharge": 0.0,
    "file_month": "2024-01",
}


def trips(spark, *changes):
    """One raw trip per dict of changes to the base trip."""
    rows = [tuple({**BASE, **change}[name] for name in NAMES) for change in changes]
    return spark.createDataFrame(rows, SCHEMA)
