from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tripmill.sources import snapshots


def rows(df):
    return sorted(map(tuple, df.collect())) if df is not None else None


def put(spark, root, **tables):
    with snapshots.Commit(spark, root) as commit:
        for name, (df, by, replaces) in tables.items():
            commit.write(name, df, by, replaces)
        return commit.publish()


def month(spark, *values):
    return spark.createDataFrame(values, "v int, m string")


def test_two_tables_change_together_and_old_versions_stay(spark, tmp_path):
    root = str(tmp_path)
    assert snapshots.current(spark, root) == 0 and snapshots.read(spark, root, "a") is None
    put(spark, root, a=(month(spark, (1, "x"), (2, "y")), "m", None), b=(spark.range(2), None, None))
    put(spark, root, a=(month(spark, (3, "y"), (9, "z")), "m", ["y"]), b=(spark.range(3), None, None))
    assert rows(snapshots.read(spark, root, "a")) == [(1, "x"), (3, "y")]  # z was not spoken for
    assert rows(snapshots.read(spark, root, "a", version=1)) == [(1, "x"), (2, "y")]
    assert snapshots.read(spark, root, "b").count() == 3 and snapshots.read(spark, root, "b", version=1).count() == 2
    assert rows(snapshots.read(spark, root, "a", partitions=["x"])) == [(1, "x")]
    assert snapshots.versions(spark, root) == [1, 2]
    sizes = {(r.table_name, r.partition): (r.rows, r.files > 0, r.bytes > 0) for r in snapshots.table_sizes(spark, root).collect()}
    assert sizes == {("a", "x"): (1, True, True), ("a", "y"): (1, True, True), ("b", ""): (3, True, True)}
    with pytest.raises(ValueError, match="no version 7"):
        snapshots.read(spark, root, "a", version=7)


def test_a_partition_without_data_is_gone_and_an_empty_table_keeps_its_columns(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, a=(month(spark, (1, "x"), (2, "y")), "m", None))
    put(spark, root, a=(month(spark).limit(0), "m", ["x"]))
    assert rows(snapshots.read(spark, root, "a")) == [(2, "y")]
    put(spark, root, a=(month(spark).limit(0), "m", ["y"]))
    empty = snapshots.read(spark, root, "a")
    assert empty.count() == 0 and empty.columns == ["v", "m"]


def test_columns_follow_the_schema_log(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, a=(spark.createDataFrame([(1, "old", "x"), (2, "old", "y")], "v int, gone string, m string"), "m", None))
    wider = spark.createDataFrame([(5_000_000_000, 0.5, "y")], "v long, new double, m string")
    put(spark, root, a=(wider, "m", ["y"]))
    table = snapshots.read(spark, root, "a")
    assert table.columns == ["v", "new", "m"]  # the dropped column stays dropped, the new one is NULL before
    assert rows(table.fillna(-1.0)) == [(1, -1.0, "x"), (5_000_000_000, 0.5, "y")]
    assert rows(snapshots.read(spark, root, "a", version=1)) == [(1, "old", "x"), (2, "old", "y")]


def test_the_second_of_two_commits_on_one_version_fails_whole(spark, tmp_path):
    root = str(tmp_path)
    first, second = snapshots.Commit(spark, root), snapshots.Commit(spark, root)
    first.write("a", month(spark, (1, "x")), "m")
    second.write("a", month(spark, (2, "x")), "m")
    second.write("b", spark.range(1))
    assert first.publish() == 1
    with pytest.raises(snapshots.ConflictError):
        second.publish()
    assert rows(snapshots.read(spark, root, "a")) == [(1, "x")] and snapshots.read(spark, root, "b") is None


@pytest.mark.parametrize("step", ["stage", "_sizes", "_list", "pointer", "rename"])
def test_a_commit_cut_off_anywhere_changes_nothing(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    put(spark, root, a=(month(spark, (1, "x")), "m", None), b=(spark.range(2), None, None))

    class Killed(Exception):
        pass

    def killed(*_, **__):
        raise Killed

    commit = snapshots.Commit(spark, root)  # no context: a lost driver cleans nothing up
    commit.write("a", month(spark, (7, "x"), (8, "y")), "m")
    if step in ("stage", "_sizes", "_list"):
        monkeypatch.setattr(commit, step, killed)
    elif step == "pointer":
        monkeypatch.setattr(snapshots.lake, "write_text", killed)
    else:
        monkeypatch.setattr(snapshots.lake, "rename_new", killed)
    with pytest.raises(Killed):
        commit.write("b", spark.range(9))
        commit.publish()
    monkeypatch.undo()
    assert snapshots.current(spark, root) == 1
    assert rows(snapshots.read(spark, root, "a")) == [(1, "x")] and snapshots.read(spark, root, "b").count() == 2
    # Work under way is left alone; taken as lost, it goes with all it wrote, and the next commit is not in its way.
    before = {p.name for p in (tmp_path / "tables/a").iterdir()}
    snapshots.expire(spark, root)
    assert {p.name for p in (tmp_path / "tables/a").iterdir()} == before
    snapshots.expire(spark, root, open_hours=0)
    assert len([p for p in (tmp_path / "tables/a").iterdir() if p.name.startswith("commit")]) == 1
    put(spark, root, a=(month(spark, (7, "x")), "m", None))
    assert rows(snapshots.read(spark, root, "a")) == [(7, "x")]


def test_old_versions_and_their_data_are_removed(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, a=(month(spark, (1, "x"), (2, "y")), "m", None))
    put(spark, root, a=(month(spark, (3, "y")), "m", ["y"]))
    put(spark, root, a=(month(spark, (4, "y")), "m", ["y"]))
    assert snapshots.expire(spark, root, keep=1) == [1, 2]
    assert rows(snapshots.read(spark, root, "a")) == [(1, "x"), (4, "y")]
    kept = sorted(str(p.relative_to(tmp_path / "tables/a")).split("/")[-1] for p in Path(root).glob("tables/a/*/m=*"))
    assert kept == ["m=x", "m=y"]  # of the first commit only the partition still in use
    with pytest.raises(ValueError, match="no version 1"):
        snapshots.read(spark, root, "a", version=1)
    assert put(spark, root, a=(month(spark, (5, "z")), "m", ["z"])) == 4


def test_damage_is_found(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, a=(month(spark, (1, "x"), (2, "y")), "m", None), b=(spark.range(1), None, None))
    assert snapshots.damaged(spark, root).count() == 0
    lost = next((tmp_path / "tables/a").glob("*/m=x/*.parquet"))
    lost.unlink()
    stray = next((tmp_path / "tables/a").glob("*/m=y")) / "stray.parquet"
    stray.write_bytes(b"x")
    found = {(r.table_name, r.folder[-3:], r.file, r.fault) for r in snapshots.damaged(spark, root).collect()}
    assert found == {("a", "m=x", lost.name, "gone"), ("a", "m=y", "stray.parquet", "not named")}
    listed = {(r.table_name, r.partition): r.rows for r in snapshots.file_list(spark, root).collect()}
    assert set(listed) == {("a", "x"), ("a", "y"), ("b", "")} and listed["a", "x"] == listed["a", "y"] == 1


def test_reading_lists_only_the_partitions_asked_for(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, a=(month(spark, (1, "x"), (2, "y")), "m", None))
    files = snapshots.read(spark, root, "a", partitions=["x"]).inputFiles()
    assert files and all("m=x" in f for f in files)
    assert snapshots.read(spark, root, "a").where(F.col("m") == "y").count() == 1
