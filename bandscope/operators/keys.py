"""Generated keys and key checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from bandscope.session import broadcast_if_small, stored
from bandscope.spec import Dimension

# monotonically_increasing_id() documents its layout: partition above bit 33, row below.
ROW_BITS = 33
# Keys in one range of dense_ids, about.
RANGE = 1_000_000


def dense_ids(keys: DataFrame, key: str, id_name: str, size: int = RANGE) -> DataFrame:
    """Number distinct keys 1..n in key order, NULL last, without sorting them in one task.

    Range partitions, as many as the keys need at ``size`` to each, are sorted on their own; each
    then starts after the rows of the ones before it. Keys are counted while they are stored. With several
    ranges the numbered copy is stored too, because where a range ends is sampled and must be the same
    for the counting and for the numbering.
    """
    in_order = F.col(key).asc_nulls_last()
    seen = Observation()
    keys = stored(keys.observe(seen, F.count("*").alias("rows")), "keys")
    ranges = max(1, -(-seen.get["rows"] // size))
    if ranges == 1:
        # At most `size` keys: one task sorts and numbers them, and there is nothing to sample.
        return keys.coalesce(1).sortWithinPartitions(in_order).select(
            key, (F.monotonically_increasing_id() + 1).alias(id_name)
        )
    numbered = stored(
        keys.repartitionByRange(ranges, in_order)
        .sortWithinPartitions(in_order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "dense-ids",
    ).select(
        key,
        F.shiftright("_slot", ROW_BITS).alias("_part"),
        F.col("_slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_row"),
    )
    # One row per range partition, so this window and this broadcast stay small at any size.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    return numbered.join(F.broadcast(starts), "_part").select(
        key, (F.col("_start") + F.col("_row") + 1).cast("bigint").alias(id_name)
    )


def category_dim(df: DataFrame, column: str, name: str, id_name: str) -> DataFrame:
    """Distinct values of a column with ids 1..n, the same on every run. NULL is no category."""
    values = df.select(F.col(column).alias(name)).where(F.col(name).isNotNull())
    return dense_ids(values.distinct(), name, id_name)


def category_dim_hash(df: DataFrame, column: str, name: str, id_name: str) -> DataFrame:
    """Distinct values with the md5 of the value as id: no order, so no sort or sampling. NULL is no category."""
    return (
        df.select(F.col(column).alias(name))
        .where(F.col(name).isNotNull())
        .distinct()
        .withColumn(id_name, F.md5(F.col(name).cast("string")))
    )


def resolve_fk(
    fact: DataFrame, dimension: DataFrame, fact_name: str, name: str, id_name: str
) -> DataFrame:
    """Add the dimension's id to the fact by name; unknown or NULL names get a NULL id."""
    side = broadcast_if_small(dimension.select(F.col(name).alias("_name"), id_name))
    return fact.join(side, fact[fact_name] == side["_name"], "left").drop("_name")


def key_report(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Per dimension: repeated keys, rows beyond the first, NULL keys, and orphan fact rows.

    Fact and dimension keys are stacked and counted per key in one aggregation. Counts combine
    before the shuffle, so a key holding much of either side costs one row per task.
    """
    reports = []
    for dimension in dimensions:
        sides = dimension.frame.select(
            F.col(dimension.key).alias("key"), F.lit(1).alias("in_dim"), F.lit(0).alias("in_fact")
        ).unionByName(
            fact.select(
                F.col(dimension.fact_key).alias("key"),
                F.lit(0).alias("in_dim"),
                F.lit(1).alias("in_fact"),
            )
        )
        per_key = sides.groupBy("key").agg(
            F.sum("in_dim").alias("in_dim"), F.sum("in_fact").alias("in_fact")
        )
        present = F.col("key").isNotNull()
        repeats = present & (F.col("in_dim") > 1)
        matched = present & (F.col("in_dim") > 0)
        total = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast("bigint")
        reports.append(
            per_key.agg(
                F.count_if(repeats).alias("repeated_keys"),
                total(F.when(repeats, F.col("in_dim") - 1)).alias("surplus_rows"),
                total(F.when(~present, F.col("in_dim"))).alias("null_keys"),
                total(F.when(~matched, F.col("in_fact"))).alias("orphan_fact_rows"),
            ).select(F.lit(dimension.name).alias("dimension"), "*")
        )
    return reduce(DataFrame.unionByName, reports).orderBy("dimension")
