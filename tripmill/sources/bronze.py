"""Landed files: contract, layout, checksums and manifests."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmill.sources.footers import column_stat, footer_catalogue
from tripmill.sources.lake import partition_names, qualified, replace_partitions

# The columns a trip file must have.
REQUIRED_TRIP_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
)
DATASET = "yellow_trips"
#: Bytes of a file that are in memory at a time while it is hashed.
BLOCK_BYTES = 1 << 20


class ContractError(ValueError):
    """A landed file does not meet the trip contract."""


def missing_columns(columns: Sequence[str]) -> list[str]:
    return sorted(set(REQUIRED_TRIP_COLUMNS) - set(columns))


def require_contract(raw: DataFrame) -> tuple[int, list[str]]:
    """Row count and columns of a valid file; raises on missing columns or no rows."""
    missing = missing_columns(raw.columns)
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    rows = raw.count()
    if rows == 0:
        raise ContractError("the file holds no rows")
    return rows, raw.columns


def write_bronze(raw: DataFrame, path: str) -> None:
    """Lay raw trips out as ``year=YYYY/month=MM`` by the month of the file."""
    replace_partitions(_placed(raw), path, ["year", "month"])


def add_bronze(raw: DataFrame, path: str) -> None:
    """Lay further files beside those their months already have."""
    _placed(raw).write.mode("append").partitionBy("year", "month").parquet(path)


def _placed(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"year": F.substring("file_month", 1, 4), "month": F.substring("file_month", 6, 2)})


def _partition(dataset_month: str) -> str:
    year, month = dataset_month.split("-")
    return f"year={year}/month={month}"


def landed_months(spark: SparkSession, path: str) -> list[str]:
    """Months with a bronze partition, from the folder listing."""
    pairs = (name.split("/") for name in partition_names(spark, path, 2))
    return [f"{year.removeprefix('year=')}-{month.removeprefix('month=')}" for year, month in pairs]


def trip_footers(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """The footer of every landed file with its ``dataset_month``; only the folders of the given months are listed."""
    months = landed_months(spark, path) if months is None else months
    files = footer_catalogue(spark, [f"{path}/{_partition(m)}" for m in months])
    year, month = (F.regexp_extract("path", f"/{name}=([^/]+)/", 1) for name in ("year", "month"))
    return files.withColumn("dataset_month", F.concat_ws("-", year, month))


def file_contracts(footers: DataFrame) -> DataFrame:
    """``footers`` with the required columns each file lacks, and whether it meets the contract."""
    required = F.array(*[F.lit(name) for name in REQUIRED_TRIP_COLUMNS])
    missing = F.array_join(F.array_sort(F.array_except(required, F.coalesce("columns", F.array()))), ",")
    return footers.withColumns(
        {"missing_columns": F.when(F.col("error").isNull(), missing).otherwise("")}
    ).withColumn("accepted", F.col("error").isNull() & (F.col("missing_columns") == ""))


def contract_report(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """Per landed month: rows, columns, what its files lack, files refused, verdict.

    Every file of a month has to meet the contract by itself, whatever the others hold; together they need a row. All
    comes from the footers of the months asked for, in one job.
    """
    months = landed_months(spark, path) if months is None else list(months)
    asked = spark.createDataFrame([(m,) for m in months], "dataset_month string")
    lacking = F.array_distinct(F.flatten(F.collect_set(F.split(F.nullif("missing_columns", F.lit("")), ","))))
    files = file_contracts(trip_footers(spark, path, months))
    known = files.groupBy("dataset_month").agg(
        F.sum("rows").alias("row_count"),
        F.max(F.size("columns")).cast("long").alias("column_count"),
        F.array_join(F.array_sort(lacking), ",").alias("missing_columns"),
        F.sum(F.when(F.col("accepted"), 0).otherwise(1)).alias("refused_files"),
        F.max("error").alias("unreadable"),
    )
    row_count, refused = F.coalesce("row_count", F.lit(0)), F.coalesce("refused_files", F.lit(0))
    return asked.join(known, "dataset_month", "left").select(
        "dataset_month",
        row_count.alias("row_count"),
        F.coalesce("column_count", F.lit(0)).alias("column_count"),
        F.coalesce("missing_columns", F.lit("")).alias("missing_columns"),
        refused.alias("refused_files"),
        "unreadable",
        ((row_count > 0) & (refused == 0)).alias("accepted"),
    )


def footer_profile(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """Rows, pickup span, missing drop-offs and the amount's bounds per month, without reading a row."""
    return (
        trip_footers(spark, path, months)
        .groupBy("dataset_month")
        .agg(
            F.sum("rows").alias("row_count"),
            F.min(column_stat("tpep_pickup_datetime", "first")).alias("first_pickup"),
            F.max(column_stat("tpep_pickup_datetime", "last")).alias("last_pickup"),
            F.sum(column_stat("tpep_dropoff_datetime", "nulls")).alias("missing_dropoffs"),
            F.sum(column_stat("PULocationID", "nulls")).alias("missing_pickup_zones"),
            F.min(column_stat("total_amount", "low")).alias("least_amount"),
            F.max(column_stat("total_amount", "high")).alias("greatest_amount"),
        )
    )


def read_bronze(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """Bronze trips of the given or all landed months with their ``dataset_month``.

    Files of one layout are one scan, so a column that some files lack is not
    made up for the others; scans of different layouts are put together by name.
    A month of one layout is named by its folder, one of several by its files.
    """
    months = landed_months(spark, path) if months is None else list(months)
    if not months:
        raise ContractError("no month has landed")
    footers = trip_footers(spark, path, months).where("error IS NULL")
    per_month = Window.partitionBy("dataset_month")
    groups = (
        footers.groupBy("dataset_month", "layout")
        .agg(F.min("path").alias("example"), F.collect_list("path").alias("files"))
        .withColumn("mixed", F.count("*").over(per_month) > 1)
        .select("dataset_month", "layout", "example", F.when(F.col("mixed"), F.col("files")).alias("files"))
        .collect()  # a row per month and layout; file names of mixed months only
    )
    scans: dict[str, list[Row]] = {}
    for row in sorted(groups, key=lambda r: (r.dataset_month, r.layout)):
        scans.setdefault(row.layout, []).append(row)
    if not scans:
        raise ContractError("no file of these months can be read")
    parts = []
    for rows in scans.values():
        schema = spark.read.parquet(rows[0].example).schema
        with_place = StructType([*schema.fields, StructField("year", StringType()), StructField("month", StringType())])
        places = [p for r in rows for p in (r.files or [f"{path}/{_partition(r.dataset_month)}"])]
        parts.append(spark.read.schema(with_place).option("basePath", path).parquet(*places))
    trips = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return trips.withColumn("dataset_month", F.concat_ws("-", "year", "month"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header, every column read as text."""
    return spark.read.csv(path, header=True, inferSchema=False)


def file_facts(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Key, size and SHA-256 of every landed file; of Parquet files also rows and columns.

    The key is the path below ``path``. Files are listed by Spark and hashed one
    task each, in blocks, straight from the shared file system: no file is ever
    one value, whatever its size. Spark passes over files of no bytes, which the
    contract refuses anyway.
    """
    root = qualified(spark, path).rstrip("/") + "/"

    # Self-contained, so that it does not need this package where it runs.
    def read(batches):
        import hashlib
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        names = ["path", "file_key", "bytes", "sha256", "rows", "columns"]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if name.startswith("file:"):
                    store, place = fs.LocalFileSystem(), "/" + name.removeprefix("file:").lstrip("/")
                else:
                    store, place = fs.FileSystem.from_uri(quote(name, safe=":/"))
                digest, size = hashlib.sha256(), 0
                with store.open_input_stream(place) as source:
                    while block := source.read(block_bytes):
                        digest.update(block)
                        size += len(block)
                rows = columns = None
                if name.endswith(".parquet"):
                    with store.open_input_file(place) as source:
                        footer = pq.ParquetFile(source)
                        rows, columns = footer.metadata.num_rows, ",".join(footer.schema_arrow.names)
                row = (name, name.removeprefix(root), size, digest.hexdigest(), rows, columns)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    block_bytes = BLOCK_BYTES
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )
    return listed.mapInArrow(
        read, "path string, file_key string, bytes long, sha256 string, rows long, columns string"
    )


def changed_files(current: DataFrame, known: DataFrame) -> DataFrame:
    """Files to upload: those whose key and digest are not both known already."""
    return current.join(known.select("file_key", "sha256"), ["file_key", "sha256"], "left_anti")


def bronze_manifest(
    spark: SparkSession,
    path: str,
    zones: str | None = None,
    known: DataFrame | None = None,
    started_at: datetime | None = None,
    completed_at: datetime | None = None,
) -> DataFrame:
    """One row per landed file: month, rows, columns, size, digest, and whether it is new.

    The zone lookup's files follow with their own records and no month.
    """
    trips = file_facts(spark, path).withColumns(
        {
            "dataset": F.lit(DATASET),
            "dataset_month": F.concat_ws(
                "-",
                F.regexp_extract("file_key", "year=([^/]+)/", 1),
                F.regexp_extract("file_key", "month=([^/]+)/", 1),
            ),
        }
    )
    files = trips
    if zones:
        lookup = file_facts(spark, zones, "*.csv")
        files = trips.unionByName(
            lookup.withColumns({"dataset": F.lit("zones"), "dataset_month": F.lit(None).cast("string")})
        )
    if known is None:
        changed = files.withColumn("changed", F.lit(True))
    else:
        seen = known.select("file_key", "sha256").distinct().withColumn("seen", F.lit(True))
        changed = files.join(seen, ["file_key", "sha256"], "left").withColumn("changed", F.col("seen").isNull())
    return changed.select(
        "dataset",
        "dataset_month",
        F.when(F.col("rows") == 0, "empty").otherwise("ready").alias("status"),
        "file_key",
        "rows",
        "columns",
        "bytes",
        "sha256",
        "changed",
        F.lit(started_at).cast("timestamp").alias("started_at"),
        F.lit(completed_at).cast("timestamp").alias("completed_at"),
    )
