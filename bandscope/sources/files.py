"""Small file steps on the folders all executors share: whole small files, and renames that never replace."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(hadoop_path(spark, path))


def listing(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    if not exists(spark, folder):
        return []
    return sorted(s.getPath().getName() for s in file_system(spark, folder).listStatus(hadoop_path(spark, folder)))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there; fail if it cannot be deleted."""
    fs, target = file_system(spark, path), hadoop_path(spark, path)
    if not fs.delete(target, True) and fs.exists(target):
        raise OSError(f"could not delete {path}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; FileExistsError if the target is there, OSError for any other failure. Nothing is replaced."""
    jvm = spark._jvm
    old, new = hadoop_path(spark, source), hadoop_path(spark, target)
    option = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(option, 1)
    options[0] = option.NONE
    context = jvm.org.apache.hadoop.fs.FileContext
    where = file_system(spark, target).makeQualified(new)
    try:
        context.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()).rename(
            file_system(spark, source).makeQualified(old), where, options
        )
    except Exception as failure:
        if "FileAlreadyExists" in str(failure):
            raise FileExistsError(target) from failure
        raise OSError(f"could not rename {source} to {target}: {failure}") from failure


def read_json(spark: SparkSession, path: str) -> dict:
    stream = file_system(spark, path).open(hadoop_path(spark, path))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """A whole file or none: written beside its place, then renamed. FileExistsError if the place is taken."""
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/_writing-{uuid.uuid4().hex}-{name}"
    stream = file_system(spark, aside).create(hadoop_path(spark, aside), True)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()
    try:
        move(spark, aside, path)
    except BaseException:
        delete(spark, aside)
        raise
