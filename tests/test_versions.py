"""Versioned folders, crash-safe swaps and landings: what a reader finds after a failure at each step."""

import pytest
from pyspark.sql import functions as F

from bandscope.session import scratch_path
from bandscope.sources import files, layers, swap, versions
from bandscope.sources.versions import Conflict, VersionedFolder, point_view, publish_version


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def values(df):
    return sorted(r.v for r in df.collect())


def test_versions_are_kept_and_vacuumed(spark):
    root = scratch_path(spark, "versions")
    folder = VersionedFolder(spark, root)
    assert folder.version() is None and folder.numbers() == []
    with pytest.raises(ValueError):
        folder.read()
    for n in (1, 2, 3):
        assert publish_version(frame(spark, n), root).number == n
    assert [values(folder.read(n)) for n in (1, 2, 3)] == [[1], [2], [3]]
    with pytest.raises(ValueError, match="no version 9"):
        folder.read(9)
    orphan = folder.write(frame(spark, 9))
    assert len(folder.vacuum(keep=2)) == 2
    assert folder.numbers() == [2, 3] and values(folder.read(2)) == [2] and values(folder.read()) == [3]
    assert not files.exists(spark, folder.place(orphan))


def test_a_version_may_read_the_one_it_replaces(spark):
    root = scratch_path(spark, "versions")
    publish_version(frame(spark, 1, 2), root)
    publish_version(VersionedFolder(spark, root).read().select((F.col("v") + 1).alias("v")), root)
    assert values(VersionedFolder(spark, root).read()) == [2, 3]


def test_a_write_that_fails_changes_nothing(spark):
    root, view = scratch_path(spark, "versions"), "default.versions_fail"
    publish_version(frame(spark, 1, 2), root, view)
    broken = frame(spark, *range(100)).select(F.when(F.col("v") < 90, F.col("v")).otherwise(F.raise_error(F.lit("boom")).cast("int")).alias("v"))
    with pytest.raises(Exception, match="boom"):
        publish_version(broken, root, view)
    assert values(spark.table(view)) == [1, 2] and VersionedFolder(spark, root).numbers() == [1]


def test_a_commit_that_fails_changes_nothing(spark, monkeypatch):
    root, view = scratch_path(spark, "versions"), "default.versions_commit"
    publish_version(frame(spark, 1), root, view)

    def fail(*_):
        raise OSError("disk gone")

    monkeypatch.setattr(files, "move", fail)
    with pytest.raises(OSError):
        publish_version(frame(spark, 2), root, view)
    monkeypatch.undo()
    assert values(spark.table(view)) == [1] and VersionedFolder(spark, root).numbers() == [1]
    assert not [n for n in files.listing(spark, f"{root}/_records") if n.startswith("_writing")]
    publish_version(frame(spark, 2), root, view)
    assert values(spark.table(view)) == [2]


def test_a_crash_before_the_view_moves(spark, monkeypatch):
    root, view = scratch_path(spark, "versions"), "default.versions_view"
    publish_version(frame(spark, 1), root, view)
    publish_version(frame(spark, 2), root)
    assert values(spark.table(view)) == [1]
    assert values(point_view(spark, root, view)) == [2]
    assert values(point_view(spark, root, view, 1)) == [1]


def test_of_two_writers_one_fails(spark):
    root = scratch_path(spark, "versions")
    folder = VersionedFolder(spark, root)
    publish_version(frame(spark, 1), root)
    seen = folder.version()
    mine, theirs = folder.write(frame(spark, 2)), folder.write(frame(spark, 3))
    folder.commit([theirs], frame(spark, 1).schema, seen)
    with pytest.raises(Conflict):
        folder.commit([mine], frame(spark, 1).schema, seen)
    assert values(folder.read()) == [3]


def test_empty_tables(spark):
    root = scratch_path(spark, "versions")
    publish_version(frame(spark), root, "default.versions_empty")
    assert values(VersionedFolder(spark, root).read()) == [] and values(spark.table("default.versions_empty")) == []


def counted_failure(monkeypatch, module, name, at):
    """Let the call number `at` of module.name fail; later ones work again."""
    real, calls = getattr(module, name), []

    def wrapped(*args):
        calls.append(args)
        if len(calls) == at:
            raise OSError("injected")
        return real(*args)

    monkeypatch.setattr(module, name, wrapped)


# Moves of a swap: the record into place, the old folder aside, the new folder into place; then two deletes.
@pytest.mark.parametrize("name, at, seen", [("move", 1, [1]), ("move", 2, [1]), ("move", 3, None), ("delete", 1, [2]), ("delete", 2, [2])])
def test_a_swap_cut_short_loses_nothing(spark, monkeypatch, name, at, seen):
    home = scratch_path(spark, "swap")
    old, new = f"{home}/table", f"{home}/made"
    frame(spark, 1).write.parquet(old)
    frame(spark, 2).write.parquet(new)
    counted_failure(monkeypatch, files, name, at)
    with pytest.raises(OSError, match="injected"):
        swap.swap_in(spark, new, old)
    monkeypatch.undo()
    if seen is not None:
        assert values(spark.read.parquet(old)) == seen
    if (name, at) == ("move", 1):
        # Nothing was promised yet.
        assert swap.recover(spark, old) is False and values(spark.read.parquet(new)) == [2]
        return
    assert swap.recover(spark, old) is True
    assert values(spark.read.parquet(old)) == [2] and swap.recover(spark, old) is False
    assert files.listing(spark, home) == ["table"]


def test_a_swap_into_an_empty_place(spark, monkeypatch):
    home = scratch_path(spark, "swap")
    frame(spark, 1).write.parquet(f"{home}/made")
    counted_failure(monkeypatch, files, "move", 2)
    with pytest.raises(OSError):
        swap.swap_in(spark, f"{home}/made", f"{home}/table")
    monkeypatch.undo()
    swap.recover(spark, f"{home}/table")
    assert values(spark.read.parquet(f"{home}/table")) == [1]


def test_a_rename_that_fails_is_no_success(spark):
    home = scratch_path(spark, "swap")
    frame(spark, 1).write.parquet(f"{home}/a")
    frame(spark, 2).write.parquet(f"{home}/b")
    with pytest.raises(FileExistsError):
        files.move(spark, f"{home}/a", f"{home}/b")
    with pytest.raises(OSError):
        files.move(spark, f"{home}/missing", f"{home}/c")
    assert files.listing(spark, home) == ["a", "b"]


@pytest.mark.parametrize("at", [1, 2, 3])
def test_landing_again_after_a_crash(spark, monkeypatch, at):
    home = scratch_path(spark, "landing")
    for n in (1, 2, 3):
        layers.write_csv(frame(spark, n), f"{home}/raw{n}")
    schema = frame(spark, 0).schema
    layers.land_bronze(spark, f"{home}/raw1", f"{home}/bronze", schema)
    counted_failure(monkeypatch, files, "move", at)
    with pytest.raises(OSError):
        layers.land_bronze(spark, f"{home}/raw2", f"{home}/bronze", schema)
    monkeypatch.undo()
    if at == 3:
        # The old folder stepped aside and the new one is not there yet; a reader of the layer finishes the swap.
        assert values(layers.read_layer(spark, home, ["bronze"])["bronze"]) == [2]
    assert values(layers.land_bronze(spark, f"{home}/raw3", f"{home}/bronze", schema)) == [3]


def test_a_layer_that_fails_keeps_its_old_tables(spark):
    home = scratch_path(spark, "layer")
    layers.write_layer({"t": frame(spark, 1)}, home)
    with pytest.raises(Exception, match="boom"):
        layers.write_layer({"t": frame(spark, 2).select(F.raise_error(F.lit("boom")).cast("int").alias("v"))}, home)
    assert files.listing(spark, home) == ["t"]
    layers.write_layer({"t": layers.read_layer(spark, home, ["t"])["t"].select((F.col("v") + 5).alias("v"))}, home)
    assert values(layers.read_layer(spark, home, ["t"])["t"]) == [6]
