"""Replace a folder by another one so that a crash at any step loses neither.

Before anything moves, a record beside the destination says what is to be done. Then the old folder steps aside, the new
one takes its place, and old folder and record are deleted. Whoever comes next finds the record and
finishes; each step can be told from what is there, so it does not matter where the last run ended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from bandscope.sources import files


def record_of(destination: str) -> str:
    folder, name = destination.rstrip("/").rsplit("/", 1)
    return f"{folder}/_swap-{name}.json"


def swap_in(spark: SparkSession, made: str, destination: str) -> None:
    """Put the complete folder `made` in the place of `destination`, whose old rows stay until it is there.

    A swap of the same destination that was cut short is finished first. A second writer at the same time fails.
    """
    recover(spark, destination)
    target = destination.rstrip("/")
    try:
        files.write_json(spark, record_of(target), {"new": made, "old": f"{target}-old-{uuid.uuid4().hex}"})
    except FileExistsError:
        raise RuntimeError(f"{target} is being replaced by another writer") from None
    recover(spark, target)


def recover(spark: SparkSession, destination: str) -> bool:
    """Finish a swap that was cut short; False if there is none. Readers may call it before they read."""
    target = destination.rstrip("/")
    record = record_of(target)
    if not files.exists(spark, record):
        return False
    told = files.read_json(spark, record)
    if files.exists(spark, told["new"]):
        if files.exists(spark, target):
            files.move(spark, target, told["old"])
        files.move(spark, told["new"], target)
    elif not files.exists(spark, target):
        raise OSError(f"{record}: neither {told['new']} nor {target} is there")
    files.delete(spark, told["old"])
    files.delete(spark, record)
    return True
