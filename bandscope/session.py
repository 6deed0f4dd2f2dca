"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution sizes and splits the shuffles. Forcing the skew split matters for the mart:
# its left joins can follow each other on one key, and without it Spark leaves a hot key in one
# task rather than add an exchange between them. Nothing changes where no partition is skewed.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Most a side may weigh to be broadcast by us, in bytes of its own data.
BROADCAST_BYTES = 32 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def named_scratch(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def use_scratch(spark: SparkSession, folder: str) -> None:
    """Name the shared scratch folder of a session that has none. A folder set already stays."""
    if not named_scratch(spark):
        spark.sparkContext.setCheckpointDir(folder)


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the session names in spark.checkpoint.dir."""
    context = spark.sparkContext
    named = named_scratch(spark)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share, or call use_scratch")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


_open_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, every scratch copy made in it.

    Frames built in the block may read such copies, so they must be written or counted inside it.
    """
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        for path in made:
            release(spark, path)


def release(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df once as Parquet in the scratch folder and read it back.

    For frames several jobs need: the copy outlives executors, keeps column pruning and
    filter pushdown, and fixes values that depend on the partition a row landed in.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """Bytes a row of df takes, from above: 16, 8 per number, the length of text. Not for nested columns."""
    widths = [
        F.coalesce(F.octet_length(field.name), F.lit(0))
        if field.dataType.typeName() in ("string", "binary")
        else F.lit(8)
        for field in df.schema.fields
    ]
    return sum(widths, F.lit(16)).cast("bigint")


def weight(df: DataFrame) -> int:
    """Bytes the rows of df take. Summed on the executors; one number comes back."""
    return df.agg(F.sum(row_bytes(df))).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring df; a larger df is returned unhinted.

    Without the hint the join shuffles, and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if weight(df) <= limit_bytes else df
