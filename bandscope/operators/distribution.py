"""Distributions per column or per group: histograms, box-plot statistics, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandscope.session import broadcast_if_small, stored
from bandscope.sources.contract import require_columns

QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 10_000  # of the sketches
MERGED = 256  # partitions whose sketches one task merges
LARGE = 1_000_000  # rows from which no task may hold a whole group
RANGE = 500_000  # sorted counts in one range, about


def finite(value: Column) -> Column:
    """Not NULL, NaN or infinite: Spark orders NaN above infinity."""
    return (value > F.lit(float("-inf"))) & (value < F.lit(float("inf")))


def with_bin(values: DataFrame, bins: int) -> DataFrame:
    """Add the equal-width bin [edge_i, edge_i+1) holding value; the last bin includes high.

    The quotient can land one bin off where value sits on an edge, so it is settled by
    comparing with the edges themselves. All in bin 0 where low = high.
    """
    value, low, high, guess = (F.col(c) for c in ("value", "low", "high", "guess"))
    width = bin_width(low, high, bins)
    # Halved, the differences stay finite whatever the range.
    scaled = F.floor((value / 2 - low / 2) / (high / 2 - low / 2) * bins)
    below = value < low + guess * width
    above = (value >= low + (guess + 1) * width) & (guess < bins - 1)
    moved = F.when(guess.isNull(), 0).when(below, guess - 1).when(above, guess + 1).otherwise(guess)
    return values.withColumn(
        "guess", F.when(high > low, F.least(scaled, F.lit(bins - 1).cast("bigint")))
    ).withColumn("bin", F.greatest(F.least(moved, F.lit(bins - 1)), F.lit(0)).cast("bigint"))


def bin_width(low: Column, high: Column, bins: int) -> Column:
    """Finite even where the range is beyond the largest double."""
    return F.when((high - low) < F.lit(float("inf")), (high - low) / bins).otherwise(high / bins - low / bins)


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """Equal-width bins from minimum to maximum: column_name, bin, lo, hi, n.

    Empty bins are present with n = 0. Values that are NULL, NaN or infinite fall in no bin;
    a column with a single value has all rows in bin 0. The range of every column is one scalar
    subquery, and all columns are counted in one scan. Reads df twice.
    """
    require_columns(df, columns)
    values = df.select(*(F.col(c).cast("double").alias(c) for c in columns))
    ranges = values.agg(
        F.struct(
            *(
                F.struct(
                    F.min(F.when(finite(F.col(c)), F.col(c))).alias("low"),
                    F.max(F.when(finite(F.col(c)), F.col(c))).alias("high"),
                ).alias(c)
                for c in columns
            )
        )
    ).scalar()
    bounds = {c: (F.col("_ranges")[c]["low"], F.col("_ranges")[c]["high"]) for c in columns}
    per_column = F.inline(
        F.array(
            *(
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col(c).alias("value"),
                    low.alias("low"),
                    high.alias("high"),
                )
                for c, (low, high) in bounds.items()
            )
        )
    )
    placed = with_bin(
        values.withColumn("_ranges", ranges).select(per_column).where(finite(F.col("value"))), bins
    ).select("column_name", "bin", F.lit(1).alias("one"))

    low, high, index = F.col("low"), F.col("high"), F.col("bin")
    width = bin_width(low, high, bins)
    every_bin = (
        df.sparkSession.range(0, bins, 1, 1)
        .withColumnRenamed("id", "bin")
        .withColumns({"_ranges": ranges, **{c: F.lit(0.0) for c in columns}})
        .select("bin", per_column)
        .select(
            "column_name",
            "bin",
            F.lit(0).alias("one"),
            (low + index * width).alias("lo"),
            F.when(index == bins - 1, high).otherwise(low + (index + 1) * width).alias("hi"),
        )
    )
    counted = (
        placed.unionByName(every_bin, allowMissingColumns=True)
        .groupBy("column_name", "bin")
        .agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("one").alias("n"))
    )
    return counted.orderBy("column_name", "bin")


def present(df: DataFrame, by: str, column: str) -> DataFrame:
    """group and value of the rows a box plot draws: neither NULL nor NaN. Negative zero is zero."""
    value = F.col(column).cast("double") + F.lit(0.0)
    values = df.select(F.col(by).alias("group"), value.alias("value"))
    return values.where(F.col("value").isNotNull() & ~F.isnan("value"))


def matching_group(side: str = "_group") -> Column:
    return F.col("group").eqNullSafe(F.col(side))


def group_sizes(values: DataFrame) -> DataFrame:
    """Rows per group, and the last input partition that has some."""
    return (
        values.withColumn("part", F.spark_partition_id())
        .groupBy(F.col("group").alias("_group"))
        .agg(F.count("*").alias("rows"), F.max("part").alias("last_part"))
    )


def bracketed(
    values: DataFrame, large_groups: DataFrame, probabilities: Sequence[float], parts: int
) -> DataFrame:
    """Keep exact only the values near the wanted quantiles of the large groups.

    Sketches give, for each probability, two values with the quantile between them. Values
    between brackets keep their place in the order but are all counted at the next bracket's
    lower edge, marked inexact, so that nearly all rows combine before the shuffle. Values of
    other groups stay as they are.
    """
    sketched = values.join(broadcast_if_small(large_groups.select("_group")), matching_group())
    brackets = stored(group_brackets(sketched, probabilities, parts), "brackets")

    joined = values.join(broadcast_if_small(brackets), matching_group(), "left")
    edges = [(F.col(f"_low_{i}"), F.col(f"_high_{i}")) for i in range(len(probabilities))]
    near = F.col("_low_0").isNull()  # not a large group
    for low, high in edges:
        near = near | F.col("value").between(low, high)
    moved = F.when(near, F.col("value"))
    for low, _ in edges:
        moved = moved.when(F.col("value") < low, low)
    return joined.select(
        "group", moved.otherwise(F.lit(float("inf"))).alias("value"), near.alias("exact")
    )


def group_brackets(values: DataFrame, probabilities: Sequence[float], parts: int) -> DataFrame:
    """Per group, _low_i and _high_i with quantile i between them, for values in ``parts`` partitions.

    A group is sketched in slices, each of every n-th partition, so that no task merges the sketches
    of more than MERGED partitions. The quantile of the whole is between the least and the greatest
    quantile of the slices. Spark bounds the rank error of a sketch by rows / ACCURACY; asking for
    twice that to either side leaves room for it and for the neighbouring ranks that interpolation
    needs. Where a slice is too short for that, the missed bracket is noticed later.
    """
    number = max(-(-parts // MERGED), 1)
    slack = 2 / ACCURACY
    around = [min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-slack, slack)]
    slices = (
        values.withColumn("slice", F.spark_partition_id() % number)
        .groupBy("group", "slice")
        .agg(F.percentile_approx("value", around, ACCURACY).alias("at"))
    )
    bounds = []
    for i in range(len(probabilities)):
        bounds.append(F.min(F.col("at")[2 * i]).alias(f"_low_{i}"))
        bounds.append(F.max(F.col("at")[2 * i + 1]).alias(f"_high_{i}"))
    return slices.groupBy(F.col("group").alias("_group")).agg(*bounds)


def sorted_counts(values: DataFrame, size: int = RANGE) -> DataFrame:
    """Distinct (group, value, exact) with their counts, in ranges of that order.

    Repeats combine before the first shuffle, and the range partitioning spreads even a single
    group over all tasks: there are as many ranges as the counts need, ``size`` to each. Stored,
    because ``part`` is only meaningful for this one layout.
    """
    order = ["group", "value", "exact"]
    counts = stored(values.groupBy(*order).agg(F.count("*").alias("n")), "counts")
    ranges = max(1, -(-counts.count() // size))
    return stored(
        counts.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()),
        "sorted-counts",
    )


def between(low: Column, high: Column, at: Column) -> Column:
    """The value at a position between the ranks around it, to the bit as Spark's percentile has it."""
    weighted = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
    return F.when((F.floor(at) == F.ceil(at)) | (low == high), low).otherwise(weighted)


def quantiles(counts: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles per group of sorted_counts: group, n, q0, q1, ..., exact.

    Totals per part locate the few parts that hold a wanted rank; only those are put in order.
    ``exact`` is false if a wanted rank fell outside its bracket.
    """
    per_group = Window.partitionBy("group")
    upto = per_group.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    position = [(F.col("total") - 1) * F.lit(p) for p in probabilities]
    ranks = F.array(*(edge(p).cast("bigint") for p in position for edge in (F.floor, F.ceil)))
    holding = (
        counts.groupBy("group", "part")
        .agg(F.sum("n").alias("rows"))
        .withColumn("after", F.sum("rows").over(upto))
        .withColumn("total", F.sum("rows").over(per_group))
        .withColumn("before", F.col("after") - F.col("rows"))
        .withColumn(
            "ranks",
            F.filter(F.array_distinct(ranks), lambda r: (r >= F.col("before")) & (r < F.col("after"))),
        )
        .where(F.size("ranks") > 0)
        .select(F.col("group").alias("_group"), F.col("part").alias("_part"), "before", "total", "ranks")
    )
    running = Window.partitionBy("group", "part").orderBy("value", "exact")
    found = (
        counts.join(
            holding,
            matching_group() & (F.col("part") == F.col("_part")),
        )
        .withColumn("last", F.col("before") + F.sum("n").over(running))
        .withColumn(
            "ranks",
            F.filter("ranks", lambda r: (r >= F.col("last") - F.col("n")) & (r < F.col("last"))),
        )
        .select("group", "value", "exact", "total", F.explode("ranks").alias("rank"))
    )

    def interpolated(p: float) -> Column:
        at = (F.col("total") - 1) * F.lit(p)
        low = F.max(F.when(F.col("rank") == F.floor(at), F.col("value")))
        high = F.max(F.when(F.col("rank") == F.ceil(at), F.col("value")))
        return between(low, high, F.max(at))

    return found.groupBy("group").agg(
        F.max("total").alias("n"),
        *(interpolated(p).alias(f"q{i}") for i, p in enumerate(probabilities)),
        F.bool_and("exact").alias("exact"),
    )


def plain_quantiles(values: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Spark's own exact percentile, which holds a group's values in one task."""
    return (
        values.groupBy("group")
        .agg(F.count("*").alias("n"), F.percentile("value", list(probabilities)).alias("at"))
        .select("group", "n", *(F.col("at")[i].alias(f"q{i}") for i in range(len(probabilities))))
    )


def ranked_quantiles(
    values: DataFrame, large_groups: DataFrame, probabilities: Sequence[float], parts: int, size: int
) -> DataFrame:
    """Quantiles of the large groups, from the values near them; from all values if a bracket was missed."""
    near = bracketed(values, large_groups, probabilities, parts)
    result = stored(quantiles(sorted_counts(near, size), probabilities), "quantiles")
    if not result.where(~F.col("exact")).isEmpty():
        whole = sorted_counts(values.withColumn("exact", F.lit(True)), size)
        result = stored(quantiles(whole, probabilities), "quantiles")
    return result.drop("exact")


def exact_quantiles(
    values: DataFrame, probabilities: Sequence[float], large: int = LARGE, size: int = RANGE
) -> DataFrame:
    """Quantiles per group: group, n, q0, q1, ..., stored.

    A group of fewer than ``large`` rows goes through percentile, in one task; a larger one is
    sketched, cut down to brackets and ranked in ranges of ``size`` counts. Both ways give the same
    bits. Where the rows in all are fewer than ``large`` no group can have more, and the sizes need no
    count of their own.
    """
    if values.count() < large:
        return stored(plain_quantiles(values, probabilities), "quantiles")
    sizes = stored(group_sizes(values), "group-sizes")
    large_groups = sizes.where(F.col("rows") >= large)
    last_part = large_groups.agg(F.max("last_part")).first()[0]
    if last_part is None:
        return stored(plain_quantiles(values, probabilities), "quantiles")
    apart = broadcast_if_small(large_groups.select("_group"))
    small = plain_quantiles(values.join(apart, matching_group(), "left_anti"), probabilities)
    big = values.join(apart, matching_group(), "left_semi")
    return stored(
        small.unionByName(ranked_quantiles(big, large_groups, probabilities, last_part + 1, size)),
        "quantiles",
    )


def fences(quartiles: DataFrame) -> DataFrame:
    """Quartiles by _group, with the fences 1.5 interquartile ranges beyond them. No range between equal quartiles."""
    spread = F.when(F.col("q2") == F.col("q0"), F.lit(0.0)).otherwise(F.col("q2") - F.col("q0"))
    reach = F.lit(1.5) * spread
    return quartiles.select(
        F.col("group").alias("_group"),
        "n",
        "q0",
        "q1",
        "q2",
        (F.col("q0") - reach).alias("fence_low"),
        (F.col("q2") + reach).alias("fence_high"),
    )


def box_stats(
    df: DataFrame, by: str, column: str, large: int = LARGE, size: int = RANGE
) -> DataFrame:
    """Box-plot statistics per group: n, quartiles, fences, whiskers and outlier count.

    Quartiles are exact. Whiskers are the extreme values within 1.5 interquartile ranges, and
    never end inside the box. Reads the two columns of df two to four times (sizes, quartiles,
    whiskers; large groups once more), so store a df that is costly to compute.

    Columns: by, n, q1, median, q3, fence_low, fence_high, whisker_low, whisker_high, outliers.
    ``large`` and ``size`` choose the way to the quartiles, not the result; see exact_quantiles.
    """
    require_columns(df, [by, column])
    values = present(df, by, column)
    box = fences(exact_quantiles(values, QUARTILES, large, size))
    inside = F.col("value").between(F.col("fence_low"), F.col("fence_high"))
    # Only what depends on the rows is aggregated over them; the box joins its group's one row.
    whiskers = (
        values.join(broadcast_if_small(box.select("_group", "fence_low", "fence_high")), matching_group())
        .groupBy("group")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("lowest"),
            F.max(F.when(inside, F.col("value"))).alias("highest"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    return whiskers.join(broadcast_if_small(box), matching_group()).select(
        F.col("group").alias(by),
        "n",
        F.col("q0").alias("q1"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q3"),
        "fence_low",
        "fence_high",
        F.least("lowest", "q0").alias("whisker_low"),
        F.greatest("highest", "q2").alias("whisker_high"),
        "outliers",
    )


def outliers(
    df: DataFrame, by: str, column: str, large: int = LARGE, size: int = RANGE
) -> DataFrame:
    """Rows of df whose value lies outside the fences of their group. Reads df as box_stats does."""
    require_columns(df, [by, column])
    quartiles = exact_quantiles(present(df, by, column), QUARTILES, large, size)
    box = stored(fences(quartiles).select("_group", "fence_low", "fence_high"), "fences")
    value = F.col(column).cast("double")
    return (
        df.where(F.col(column).isNotNull() & ~F.isnan(value))
        .join(broadcast_if_small(box), F.col(by).eqNullSafe(F.col("_group")))
        .where((value < F.col("fence_low")) | (value > F.col("fence_high")))
        .select(*df.columns)
    )
