"""The heaviest values of a column with any number of distinct ones, exactly, from bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.session import stored

# Hash buckets: rows of the summary at most, and of each list of buckets that is broadcast.
BUCKETS = 1 << 16


def top_values(df: DataFrame, column: str, k: int, buckets: int = BUCKETS) -> DataFrame:
    """The k values with the most rows and their `total`; of equal ones the smaller value comes first. NULL is a value.

    A summary counts rows by hash of the value. A bucket's count is at least that of each value in it, so the values of the k
    heaviest buckets, counted exactly, tell a count that the k-th value has or exceeds; no value of a bucket
    below it can be among the k, and only those of the other buckets are counted. Nothing is missed, however
    the values are distributed: the summary only says how few have to be counted. Shuffled are the summary
    (``buckets`` rows a task at most) and the counts of the values that remain.
    """
    if k < 1:
        raise ValueError(f"k is {k}; at least one value must be asked for")
    value = F.col(f"`{column}`").alias(column)
    keyed = df.select(value, F.pmod(F.xxhash64(value), F.lit(buckets)).alias("_bucket"))
    summary = stored(keyed.groupBy("_bucket").agg(F.count("*").alias("_rows")), "summary")

    def counted(some: DataFrame) -> DataFrame:
        inside = keyed.join(F.broadcast(some.select("_bucket")), "_bucket", "left_semi")
        return inside.groupBy(column).agg(F.count("*").alias("total"))

    heaviest = summary.orderBy(F.desc("_rows"), "_bucket").limit(k)
    least = counted(heaviest).orderBy(F.desc("total")).limit(k).agg(F.count("*").alias("n"), F.min("total").alias("least")).first()
    bound = least["least"] if least["n"] == k else 0
    return counted(summary.where(F.col("_rows") >= bound)).orderBy(F.desc("total"), F.col(f"`{column}`").asc_nulls_last()).limit(k)
