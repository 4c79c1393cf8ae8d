"""Exports, serving slices and manifests."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import derived_id, month_text
from tripmill.sources.bronze import file_facts
from tripmill.sources.lake import exists, qualified, read_table, replace_partitions

# Exported models, their layer and the column that places a row in a month.
EXPORTS = {
    "fact_trips": ("silver", "dataset_month"),
    "silver_quarantine": ("silver", "dataset_month"),
    "dim_zone": ("silver", None),
    "mart_daily_demand": ("gold", "trip_date"),
    "mart_zone_performance": ("gold", "trip_date"),
    "mart_hourly_pattern": ("gold", "dataset_month"),
}
ALL_MONTHS = "all"


def with_month(model: str, df: DataFrame) -> DataFrame:
    """The model with the month each row is published under."""
    column = EXPORTS[model][1]
    if column is None:
        return df.withColumn("dataset_month", F.lit(ALL_MONTHS))
    if column == "dataset_month":
        return df
    return df.withColumn("dataset_month", month_text(column))


def export_path(root: str, model: str) -> str:
    return f"{root}/{EXPORTS[model][0]}/{model}"


def export_model(model: str, df: DataFrame, root: str, dataset_month: str | None = None) -> None:
    """Write a model as ZSTD Parquet under ``layer/model/year=/month=``.

    With a month only that slice is written, otherwise every month present. A
    model without months is written whole into the slice of the given month.
    """
    placed = with_month(model, df)
    if dataset_month:
        if EXPORTS[model][1] is None:
            placed = df.withColumn("dataset_month", F.lit(dataset_month))
        else:
            placed = placed.where(F.col("dataset_month") == dataset_month)
    parts = F.split("dataset_month", "-")
    keyed = placed.withColumns(
        {"year": F.get(parts, F.lit(0)), "month": F.coalesce(F.get(parts, F.lit(1)), F.lit(ALL_MONTHS))}
    )
    if EXPORTS[model][1] != "dataset_month":
        keyed = keyed.drop("dataset_month")
    replace_partitions(keyed, export_path(root, model), ["year", "month"], derived=derived_id(keyed.columns))


def export_models(
    models: Mapping[str, DataFrame], root: str, dataset_month: str | None = None
) -> None:
    for model in EXPORTS:
        export_model(model, models[model], root, dataset_month)


def read_export(spark: SparkSession, root: str, model: str) -> DataFrame:
    return read_table(spark, export_path(root, model))


def _export_month() -> Column:
    return F.when(F.col("year") == ALL_MONTHS, ALL_MONTHS).otherwise(
        F.concat_ws("-", "year", "month")
    )


def export_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows per exported model and month, counted on the written files.

    Only the partition columns are asked for, so the counts come from footers
    and a model without any exported row needs no schema.
    """
    counts = [
        spark.read.schema("year string, month string")
        .parquet(export_path(root, model))
        .groupBy("year", "month")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(model).alias("model"), _export_month().alias("dataset_month"), "rows")
        for model in EXPORTS
    ]
    return reduce(DataFrame.unionByName, counts)


def export_files(
    spark: SparkSession, root: str, dataset_month: str | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Every exported file with its model, month, rows, size and digest, and whether it is new.

    With a month only that month's folders are listed.
    """
    found = []
    for model in EXPORTS:
        place = export_path(root, model)
        if dataset_month:
            year, month = dataset_month.split("-")
            place = f"{place}/year={year}/month={month}"
            if not exists(spark, place):
                continue
        found.append(file_facts(spark, place).withColumn("model", F.lit(model)))
    whole, base = F.col("path"), qualified(spark, root).rstrip("/") + "/"
    files = reduce(DataFrame.unionByName, found).select(
        "model",
        F.regexp_extract(whole, "/year=([^/]+)/", 1).alias("year"),
        F.regexp_extract(whole, "/month=([^/]+)/", 1).alias("month"),
        F.substring(whole, len(base) + 1, 1 << 30).alias("file_key"),
        "rows",
        "bytes",
        "sha256",
    ).withColumn("dataset_month", _export_month())
    if known is None:
        return files.withColumn("uploaded", F.lit(True))
    seen = known.select("file_key", "sha256").distinct().withColumn("seen", F.lit(True))
    return files.join(seen, ["file_key", "sha256"], "left").withColumn("uploaded", F.col("seen").isNull()).drop("seen")


def export_records(
    spark: SparkSession, root: str, dataset_month: str | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Per model and month: rows, bytes, and the list of files to verify them by."""
    files = export_files(spark, root, dataset_month, known)
    return files.groupBy("model", "dataset_month").agg(
        F.sum("rows").alias("rows"),
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.array_sort(F.collect_list(F.struct("file_key", "bytes", "sha256", "uploaded"))).alias("file_list"),
    )


def publish_manifest(runs: DataFrame, records: DataFrame) -> DataFrame:
    """One document per run with its export records nested.

    A month has as many records as there are models, so the list stays short.
    """
    nested = records.groupBy("dataset_month").agg(
        F.array_sort(F.collect_list(F.struct("model", "rows", "files", "bytes", "file_list"))).alias("exports")
    )
    return runs.join(nested, "dataset_month", "left")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One JSON folder per month; a rerun replaces its own month."""
    (
        manifest.withColumn("month", F.col("dataset_month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .json(path)
    )


def publish_gold(model: str, mart: DataFrame, root: str) -> None:
    """Replace the serving slice of every month that occurs in ``mart``."""
    replace_partitions(with_month(model, mart), export_path(root, model), ["dataset_month"])


def read_gold(spark: SparkSession, root: str, model: str) -> DataFrame:
    table = read_table(spark, export_path(root, model))
    return table if EXPORTS[model][1] == "dataset_month" else table.drop("dataset_month")
