"""Session settings every job of this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

REQUIRED = {
    # Dates, hours and identity text are all read off instants in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Only the partitions present in the written data are replaced.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Typed timestamps carry min/max statistics, so pickup ranges prune row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The per-minute state has no upper bound; keep it off the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "tripmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        # Call sites of single expressions are not worth a JVM call each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**REQUIRED, **defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session somebody else created."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
