"""A catalogue of Parquet footers: what every file holds, read by Spark tasks from the file list, without a data scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATS = (
    "array<struct<column: string, type: string, nulls: bigint, low: double, high: double, "
    "first: timestamp_ntz, last: timestamp_ntz>>"
)
CATALOGUE = f"path string, bytes long, rows long, columns array<string>, layout string, stats {STATS}, error string"


def opener():
    """A function that opens a file by the name Spark lists it under; it runs where this package is not installed."""

    def opened(name: str):
        from urllib.parse import quote

        from pyarrow import fs

        if name.startswith("file:"):
            return fs.LocalFileSystem().open_input_file("/" + name.removeprefix("file:").lstrip("/"))
        store, place = fs.FileSystem.from_uri(quote(name, safe=":/"))
        return store.open_input_file(place)

    return opened


def listed_files(spark: SparkSession, paths: Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """(path): the files below the given folders; contents are not read."""
    if not paths:
        return spark.createDataFrame([], "path string")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        .select("path")
    )


def footer_catalogue(spark: SparkSession, paths: Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """One row per file: size, rows, columns, layout and column statistics, or why its footer cannot be read.

    ``layout`` names columns with their types in order, so files of one layout can be one scan. Bounds are given where
    every row group has them: of numbers and days (since 1970) as doubles, of times as times.
    """
    opened = opener()

    def read(batches):
        from datetime import UTC, date, datetime
        from decimal import Decimal

        import pyarrow as pa
        import pyarrow.parquet as pq

        stat = pa.struct(
            [
                ("column", pa.string()),
                ("type", pa.string()),
                ("nulls", pa.int64()),
                ("low", pa.float64()),
                ("high", pa.float64()),
                ("first", pa.timestamp("us")),
                ("last", pa.timestamp("us")),
            ]
        )
        schema = pa.schema(
            [
                ("path", pa.string()),
                ("bytes", pa.int64()),
                ("rows", pa.int64()),
                ("columns", pa.list_(pa.string())),
                ("layout", pa.string()),
                ("stats", pa.list_(stat)),
                ("error", pa.string()),
            ]
        )

        def number(value):
            if isinstance(value, datetime):
                return None
            if isinstance(value, date):
                return float((value - date(1970, 1, 1)).days)
            return float(value) if isinstance(value, int | float | Decimal) else None

        def moment(value):
            if not isinstance(value, datetime):
                return None
            return value.astimezone(UTC).replace(tzinfo=None) if value.tzinfo else value

        def stats_of(meta, place, name, kind):
            groups = [meta.row_group(i).column(place).statistics for i in range(meta.num_row_groups)]
            nulls = None
            if all(g is not None and g.has_null_count for g in groups):
                nulls = sum(g.null_count for g in groups)
            row = {"column": name, "type": kind, "nulls": nulls, "low": None, "high": None, "first": None, "last": None}
            # A row group of nulls alone has no bounds and needs none.
            sizes = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
            if nulls is None:
                return row
            bounded = [g for g, n in zip(groups, sizes) if g.null_count < n]
            if bounded and all(g.has_min_max for g in bounded):
                lows, highs = [g.min for g in bounded], [g.max for g in bounded]
                for low, high, convert in (("low", "high", number), ("first", "last", moment)):
                    if convert(lows[0]) is not None:
                        row[low], row[high] = min(map(convert, lows)), max(map(convert, highs))
            return row

        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                row = dict.fromkeys(schema.names)
                row["path"] = path
                try:
                    with opened(path) as source:
                        row["bytes"] = source.size()
                        footer = pq.ParquetFile(source)
                        meta = footer.metadata
                        leaves = [footer.schema.column(i) for i in range(len(footer.schema))]
                        kinds = [f"{c.path}:{c.physical_type}:{c.logical_type}" for c in leaves]
                        row["rows"] = meta.num_rows
                        row["columns"] = footer.schema_arrow.names
                        row["layout"] = ",".join(kinds)
                        row["stats"] = [
                            stats_of(meta, i, c.path, f"{c.physical_type}:{c.logical_type}") for i, c in enumerate(leaves)
                        ]
                except (OSError, pa.ArrowInvalid) as fault:
                    row["error"] = str(fault).splitlines()[0]
                rows.append(row)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return listed_files(spark, paths, pattern).mapInArrow(read, CATALOGUE)


def column_stat(column: str, field: str) -> Column:
    """A statistic of one column from the catalogue's ``stats``."""
    return F.get(F.filter("stats", lambda s: s["column"] == column), F.lit(0))[field]
