"""Several tables as one: every change is a new version, and one pointer switch shows all of it or nothing.

Below a lake root:

    tables/<table>/commit=<id>/[<column>=<value>/]   data of one commit, written once and never changed
    snapshots/manifests/<version>-<id>               which folder holds each partition of each table (Parquet)
    snapshots/commits/<version>                      the pointer: names the manifest; the greatest one is current
    snapshots/files/<id>                             the footers of the files a commit wrote (Parquet)
    snapshots/open/<id>                              commits under way, so that cleaning leaves their folders alone

A commit writes its partitions into folders of its own, then the manifest of all tables, then renames the pointer into
place, which fails if that version exists by now. Whatever is lost before the rename leaves the old version whole; what
a lost commit wrote is named by no manifest and is removed by ``expire``. Readers fix a version once and keep it.

The manifest has a row per table and partition, so it grows with the calendar and not with the data; rows and bytes in
it are added up from the footers, which are listed once per commit and never pass the driver. It is also the schema log: each partition is read with the schema it was written in
and then given the table's columns of that version, so a column that was dropped stays dropped and no reader merges
footers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripmill.sources import footers, lake

MANIFEST = (
    "table_name string, partition_column string, partition string, folder string, schema string, rows long, "
    "bytes long, files long"
)


class ConflictError(RuntimeError):
    """Another commit became the next version first; nothing of this one is visible."""


def _place(root: str, kind: str, name: str = "") -> str:
    return f"{root}/snapshots/{kind}/{name}".rstrip("/")


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions that have not been removed, in order."""
    return sorted(int(name) for name in lake.names_in(spark, _place(root, "commits")) if name.isdigit())


def current(spark: SparkSession, root: str) -> int:
    """The version readers see; 0 before the first commit."""
    return max(versions(spark, root), default=0)


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A row for each table (without a folder) with its schema, and one for each of its partitions."""
    version = current(spark, root) if version is None else version
    if version == 0:
        return spark.createDataFrame([], MANIFEST)
    if version not in versions(spark, root):
        raise ValueError(f"there is no version {version} of {root}")
    name = lake.read_text(spark, _place(root, "commits", f"{version:08d}"))
    return spark.read.schema(MANIFEST).parquet(_place(root, "manifests", name))


def _schema(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))


def _as(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows in the given columns: others go, missing ones are NULL."""
    own = set(df.columns)
    return df.select(
        *((F.col(f"`{f.name}`") if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema)
    )


def _read(spark: SparkSession, root: str, table: str, rows: Sequence, partitions: Sequence[str] | None) -> DataFrame | None:
    """A table from its manifest rows."""
    head = [r for r in rows if r.folder is None]
    if not head:
        return None
    schema, base = _schema(head[0].schema), f"{root}/tables/{table}"
    groups: dict[str, list[str]] = {}
    for r in rows:
        if r.folder is not None and (partitions is None or r.partition in partitions):
            groups.setdefault(r.schema, []).append(f"{base}/{r.folder}")
    place = [StructField(head[0].partition_column, StringType())] if head[0].partition_column else []
    parts = []
    for written, folders in sorted(groups.items()):
        kept = [f for f in _schema(written).fields if f.name not in {p.name for p in place}]
        files = spark.read.schema(StructType([*kept, *place])).option("basePath", base).parquet(*sorted(folders))
        parts.append(_as(files, schema))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read(
    spark: SparkSession,
    root: str,
    table: str,
    version: int | None = None,
    partitions: Sequence[str] | None = None,
) -> DataFrame | None:
    """A table as of a version, or only some of its partitions; None if that version does not have it.

    Only the folders asked for are listed, and no footer is opened to find a schema.
    """
    rows = manifest(spark, root, version).where(F.col("table_name") == table).collect()  # a row per partition
    return _read(spark, root, table, rows, partitions)


def table_sizes(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(table_name, partition, rows, files, bytes) from the manifest alone."""
    return manifest(spark, root, version).where("folder IS NOT NULL").select(
        "table_name", "partition", "rows", "files", "bytes"
    )


class Commit:
    """Changes to several tables that become visible together.

    ``base`` is the version the changes are made against. A commit that is not finished changes nothing; used as a
    context it is given up when the block raises, and has to be finished by ``publish``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.id = spark, root, uuid.uuid4().hex
        self.base = current(spark, root)
        self._staged: dict[str, DataFrame] = {}
        self._found = manifest(spark, root, self.base).collect()
        self._rows = {(r.table_name, r.partition): tuple(r) for r in self._found}
        lake.write_text(spark, _place(root, "open", self.id), str(self.base))

    def __enter__(self) -> Commit:
        return self

    def __exit__(self, kind, *_: object) -> None:
        if kind is not None:
            self.give_up()

    def read(self, table: str, partitions: Sequence[str] | None = None) -> DataFrame | None:
        """The table as this commit found it."""
        return _read(self.spark, self.root, table, [r for r in self._found if r.table_name == table], partitions)

    def held(self, table: str) -> set[str]:
        """Partitions of the table as this commit found it."""
        return {r.partition for r in self._found if r.table_name == table and r.folder is not None}

    def stage(
        self,
        table: str,
        df: DataFrame,
        by: str | None = None,
        order: Sequence[str] = (),
        derived: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Write data into this commit's folder of the table and read it again; nothing refers to it yet."""
        path = f"{self.root}/tables/{table}/commit={self.id}"
        if by:
            lake.replace_partitions(df, path, [by], order, derived)
            self._staged[table] = lake.read_table(self.spark, path, df.schema)
        else:
            df.write.mode("overwrite").options(**lake.PLAIN_DIGEST).parquet(path)
            self._staged[table] = self.spark.read.schema(df.schema).parquet(path)
        return self._staged[table]

    def staged(self, table: str) -> DataFrame:
        """What this commit has written for a table."""
        return self._staged[table]

    def put(self, table: str, schema: StructType, by: str | None = None, replaces: Sequence[str] | None = None) -> None:
        """Let the staged partitions of a table take the place of its old ones.

        ``replaces`` names the partitions this commit speaks for: staged ones of other names are left out, and a named
        one without data is gone. Without it the table is replaced whole.
        """
        path, folder = f"{self.root}/tables/{table}/commit={self.id}", f"commit={self.id}"
        found = {""} if by is None else {n.partition("=")[2] for n in lake.partition_names(self.spark, path, 1)}
        if by is None or replaces is None:
            gone = {p for name, p in self._rows if name == table}
        else:
            gone, found = set(replaces), found & set(replaces)
        for partition in gone:
            self._rows.pop((table, partition), None)
        text = schema.json()
        self._rows[table, None] = (table, by, None, None, text, 0, 0, 0)
        for partition in sorted(found):
            place = f"{folder}/{by}={partition}" if by else folder
            self._rows[table, partition] = (table, by, partition, place, text, 0, 0, 0)

    def _sizes(self) -> None:
        """Note rows, bytes and files of all that this commit puts, in one job over its files' footers."""
        new = {(row[0], row[3]): key for key, row in self._rows.items() if (row[3] or "").startswith(f"commit={self.id}")}
        if not new:
            return
        written = footers.footer_catalogue(self.spark, [f"{self.root}/tables/{t}/{f}" for t, f in sorted(new)])
        listing = _place(self.root, "files", self.id)
        named = {
            "table_name": F.regexp_extract("path", "/tables/([^/]+)/commit=", 1),
            "folder": F.regexp_extract("path", "/(commit=.*)/[^/]+$", 1),
            "file": F.substring_index("path", "/", -1),
        }
        written.withColumns(named).drop("path").write.mode("overwrite").parquet(listing)
        added = self.spark.read.parquet(listing).groupBy("table_name", "folder").agg(
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.count("*").alias("n"),
            F.max("error").alias("error"),
        )
        for r in added.collect():  # a row per partition
            if r.error:
                raise RuntimeError(f"a file just written cannot be read: {r.error}")
            key = new[r.table_name, r.folder]
            self._rows[key] = (*self._rows[key][:5], r.rows, r.bytes, r.n)

    def write(
        self,
        table: str,
        df: DataFrame,
        by: str | None = None,
        replaces: Sequence[str] | None = None,
        order: Sequence[str] = (),
        derived: Mapping[str, Column] | None = None,
    ) -> DataFrame:
        """Stage and put in one; returns what was staged."""
        staged = self.stage(table, df, by, order, derived)
        self.put(table, df.schema, by, replaces)
        return staged

    def publish(self) -> int:
        """Make the changes the next version; raises if another commit has become it."""
        version, spark = self.base + 1, self.spark
        name = f"{version:08d}-{self.id}"
        self._sizes()
        self._list(name)
        pointer = _place(self.root, "commits", f"{version:08d}")
        waiting = _place(self.root, "open", f"{self.id}.pointer")
        lake.write_text(spark, waiting, name)
        if not lake.rename_new(spark, waiting, pointer):
            self.give_up()
            raise ConflictError(f"version {version} of {self.root} was committed by another writer")
        lake.delete(spark, _place(self.root, "open", self.id))
        return version

    def _list(self, name: str) -> None:
        """Write the manifest of all tables as this commit leaves them."""
        rows = self.spark.createDataFrame(list(self._rows.values()), MANIFEST)
        rows.coalesce(1).write.parquet(_place(self.root, "manifests", name))

    def give_up(self) -> None:
        """Leave no mark; the data written so far goes with the next ``expire``."""
        for name in (self.id, f"{self.id}.pointer"):
            lake.delete(self.spark, _place(self.root, "open", name))


def expire(spark: SparkSession, root: str, keep: int = 2, open_hours: float = 24) -> list[int]:
    """Remove all but the last ``keep`` versions and all data no kept version needs; returns the versions removed.

    Versions go first and data after, so a cleaning that is cut off leaves no version without its data. Folders of
    commits under way are left alone, unless they were opened more than ``open_hours`` ago and are taken as lost.
    """
    if keep < 1:
        raise ValueError("at least one version has to be kept")
    known = versions(spark, root)
    old, kept = known[:-keep], known[-keep:]
    opened = {n for n in lake.names_in(spark, _place(root, "open"), younger_than_hours=open_hours)}
    used: set[tuple[str, str]] = set()
    manifests = {lake.read_text(spark, _place(root, "commits", f"{v:08d}")) for v in kept}
    for version in kept:
        rows = manifest(spark, root, version).where("folder IS NOT NULL").select("table_name", "folder").distinct()
        used |= {(r.table_name, r.folder) for r in rows.collect()}
    for version in old:
        lake.delete(spark, _place(root, "commits", f"{version:08d}"))
    for name in lake.names_in(spark, _place(root, "manifests")):
        if name not in manifests and name.partition("-")[2] not in opened:
            lake.delete(spark, _place(root, "manifests", name))
    for name in lake.names_in(spark, _place(root, "open")):
        if name.partition(".")[0] not in opened:
            lake.delete(spark, _place(root, "open", name))
    for commit in lake.names_in(spark, _place(root, "files")):
        if commit not in opened and not any(f.split("/")[0] == f"commit={commit}" for _, f in used):
            lake.delete(spark, _place(root, "files", commit))
    for table in lake.names_in(spark, f"{root}/tables"):
        for commit in lake.names_in(spark, f"{root}/tables/{table}"):
            if commit.partition("=")[2] in opened:
                continue
            base = f"{root}/tables/{table}/{commit}"
            needed = {f for t, f in used if t == table and f.split("/")[0] == commit}
            if not needed:
                lake.delete(spark, base)
            elif commit not in needed:
                for part in lake.names_in(spark, base):
                    if "=" in part and f"{commit}/{part}" not in needed:
                        lake.delete(spark, f"{base}/{part}")
    return old


def file_list(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The footers of all files of a version: (table_name, partition, folder, file, rows, bytes, columns, stats)."""
    parts = manifest(spark, root, version).where("folder IS NOT NULL").select("table_name", "partition", "folder")
    ids = parts.select(F.regexp_extract("folder", "^commit=([^/]+)", 1).alias("id")).distinct().collect()
    if not ids:
        return parts.withColumns({"file": F.lit(""), "rows": F.lit(0), "bytes": F.lit(0)})
    files = spark.read.parquet(*sorted(_place(root, "files", r.id) for r in ids))
    return files.select("table_name", "folder", "file", "rows", "bytes", "columns", "stats").join(parts, ["table_name", "folder"])


def damaged(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(table_name, folder, file, fault): files a version names that are gone, and files it does not name."""
    parts = manifest(spark, root, version).where("folder IS NOT NULL").select("table_name", "folder").collect()
    named = file_list(spark, root, version).select("table_name", "folder", "file")
    present = [f for f in (f"{root}/tables/{r.table_name}/{r.folder}" for r in parts) if lake.exists(spark, f)]
    there = footers.listed_files(spark, present).select(
        F.regexp_extract("path", "/tables/([^/]+)/commit=", 1).alias("table_name"),
        F.regexp_extract("path", "/(commit=.*)/[^/]+$", 1).alias("folder"),
        F.substring_index("path", "/", -1).alias("file"),
    )
    key = ["table_name", "folder", "file"]
    gone = named.join(there, key, "left_anti").withColumn("fault", F.lit("gone"))
    return gone.unionByName(there.join(named, key, "left_anti").withColumn("fault", F.lit("not named")))
