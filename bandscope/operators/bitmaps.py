"""Key checks by bitmaps, for whole-number keys that lie densely."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandscope.operators.keys import key_report
from bandscope.session import broadcast_if_small, stored
from bandscope.spec import Dimension


def bucket(key: Column) -> Column:
    """The bucket of 32,768 neighbouring keys that a key falls in."""
    return F.bitmap_bucket_number(key.cast("bigint"))


def bitmap(key: Column) -> Column:
    return F.bitmap_construct_agg(F.bitmap_bit_position(key.cast("bigint")))


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(bucket, keys, bits) of the non-null keys: how many rows, and which keys, as 4 KB a bucket.

    Rows of a task combine before the shuffle, so it moves one bitmap for each bucket and task instead of the keys. Over
    dense keys that is a bit or so for each; over keys so sparse that a bucket holds only a few it is more than the keys.
    """
    value = F.col(f"`{key}`")
    return (
        df.where(value.isNotNull())
        .groupBy(bucket(value).alias("bucket"))
        .agg(F.count("*").alias("keys"), bitmap(value).alias("bits"))
    )


def suspect_buckets(fact: DataFrame, dimension: Dimension) -> DataFrame:
    """(bucket) where a dimension key repeats or a fact key has no partner, told from bitmaps alone.

    A key repeats if a bucket has more rows than bits; a fact key is an orphan if the bits of both sides are more than
    the dimension's.
    """
    dim = key_bitmaps(dimension.frame, dimension.key).select("bucket", "keys", "bits", F.lit(True).alias("in_dim"))
    facts = key_bitmaps(fact, dimension.fact_key).select("bucket", F.lit(0).cast("bigint").alias("keys"), "bits", F.lit(False).alias("in_dim"))
    ours = F.coalesce(F.sum(F.when(F.col("in_dim"), F.bitmap_count("bits"))), F.lit(0))
    return (
        dim.unionByName(facts)
        .groupBy("bucket")
        .agg(F.sum("keys").alias("keys"), ours.alias("ours"), F.bitmap_count(F.bitmap_or_agg("bits")).alias("all"))
        .where("keys > ours OR all > ours")
        .select("bucket")
    )


def key_report_by_bitmaps(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """`key_report` for whole-number keys. Only rows of buckets that bitmaps find fault with are counted by key.

    Null keys have no bucket and are counted as they are. With clean keys the exact part reads no rows beyond them.
    """
    reports = []
    for dimension in dimensions:
        for frame, key in ((dimension.frame, dimension.key), (fact, dimension.fact_key)):
            kind = frame.schema[key].dataType.typeName()
            if kind not in ("byte", "short", "integer", "long"):
                raise ValueError(f"key {key} of {dimension.name} is no whole number but {kind}")
        found = stored(suspect_buckets(fact, dimension), "suspect-buckets")

        def suspects(df: DataFrame, key: str) -> DataFrame:
            value = F.col(f"`{key}`")
            keyed = df.select(value.cast("bigint").alias("key")).withColumn("bucket", bucket(F.col("key")))
            inside = keyed.join(broadcast_if_small(found), "bucket", "left_semi").select("key")
            return inside.unionByName(keyed.where(F.col("key").isNull()).select("key"))

        part = Dimension(dimension.name, suspects(dimension.frame, dimension.key), "key", "key", [])
        reports.append(key_report(suspects(fact, dimension.fact_key), [part]))
    return reduce(DataFrame.unionByName, reports).orderBy("dimension")
