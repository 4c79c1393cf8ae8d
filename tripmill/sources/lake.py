"""Where tables live and how their partitions are replaced."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="run-")
    return _local_roots[context.applicationId]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared root; it is only named here, not created."""
    return f"{shared_root(spark).rstrip('/')}/tripmill/{name}-{uuid.uuid4().hex}"


# Digests never repeat enough for a dictionary to pay.
PLAIN_DIGEST = {"parquet.enable.dictionary#trip_id": "false"}


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many: several consumers share a result without recomputing it.

    The written table also cuts the lineage, so a lost executor costs a re-read.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").options(**PLAIN_DIGEST).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str], order: Sequence[str] = (), derived: Mapping[str, Column] | None = None
) -> None:
    """Replace exactly the partitions that occur in ``df``.

    The rebalance hint sizes the files: small partitions are gathered into one
    file, and a partition holding most of the rows is split over many tasks.
    ``order`` sorts the rows within files, so that row groups cover narrow ranges.
    ``derived`` columns do not travel: the writing tasks compute them from the others.
    """
    sized = df.drop(*(derived or ())).hint("rebalance", *by)
    if derived:
        sized = sized.withColumns(dict(derived)).select(*df.columns)
    if order:
        sized = sized.sortWithinPartitions(*by, *order)
    (
        sized.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .options(**PLAIN_DIGEST)
        .partitionBy(*by)
        .parquet(path)
    )


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as file listings spell it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def partition_names(spark: SparkSession, path: str, levels: int) -> list[str]:
    """Partition folders below a table, from the file system's listing alone."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    pattern = spark._jvm.org.apache.hadoop.fs.Path(target, "/".join(["*=*"] * levels))
    found = [status.getPath().toString() for status in files.globStatus(pattern)]
    return sorted("/".join(name.split("/")[-levels:]) for name in found)


def names_in(spark: SparkSession, path: str, younger_than_hours: float | None = None) -> list[str]:
    """Names of what a folder holds; none if it is not there. Marker and checksum files do not count."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    found = [(s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(target)]
    if younger_than_hours is not None:
        least = (time.time() - younger_than_hours * 3600) * 1000
        found = [(name, at) for name, at in found if at >= least]
    return sorted(name for name, _ in found if name[0] not in "._")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one go."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file to a name that must not be taken; says whether it did. Atomic where the file system's rename is."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    conf = spark._jsc.hadoopConfiguration()
    files = new.getFileSystem(conf)
    files.mkdirs(new.getParent())
    context = hadoop.FileContext.getFileContext(files.getUri(), conf)
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(old), files.makeQualified(new), no_options)
    except Py4JJavaError as fault:
        if "FileAlreadyExistsException" in fault.java_exception.getClass().getName():
            return False
        raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """Remove partitions that lost their last row; an overwrite leaves them in place."""
    for value in values:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    spark.catalog.refreshByPath(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    merge_schema: bool = False,
    partition: str | None = None,
) -> DataFrame:
    """A partitioned table; partition values stay text (``2024-01``, ``01``) as written.

    With a schema no file is opened to find one. Merging looks at every footer,
    so it is for readers who need columns that only some months have.
    """
    spark.catalog.refreshByPath(path)
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(inference)
    spark.conf.set(inference, "false")
    try:
        reader = spark.read.option("mergeSchema", str(merge_schema).lower()).option("basePath", path)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(f"{path}/{partition}" if partition else path)
    finally:
        spark.conf.set(inference, before)
