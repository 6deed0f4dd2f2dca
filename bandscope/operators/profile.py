"""Table profiles: counts, missing values, summaries, frequencies and shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandscope.functions.bands import value_rank
from bandscope.sources.contract import require_columns


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, largest first, equal counts by name."""
    counts = [
        df.agg(F.count("*").alias("total")).select(F.lit(name).alias("table_name"), "total")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("total"), "table_name")


def null_profile(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Total rows and NULLs per column. NaN is a value here, as in SQL."""
    require_columns(df, columns)
    return df.agg(
        F.count("*").alias("total"),
        *(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns),
    ).select(F.lit(label).alias("table_name"), "*")


def missing(df: DataFrame, column: str) -> Column:
    """True for NULL, and for NaN in a floating-point column."""
    value = F.col(column)
    if df.schema[column].dataType.typeName() in ("float", "double"):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def cell_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Cells (rows x columns), missing cells and valid cells per table; NaN counts as missing."""
    profiles = []
    for name, df in tables.items():
        per_row = sum((missing(df, c).cast("int") for c in df.columns), F.lit(0))
        profiles.append(
            df.agg(
                (F.count("*") * len(df.columns)).alias("cells"),
                F.coalesce(F.sum(per_row), F.lit(0)).cast("bigint").alias("null_cells"),
            ).select(
                F.lit(name).alias("table_name"),
                "cells",
                "null_cells",
                (F.col("cells") - F.col("null_cells")).alias("valid_cells"),
            )
        )
    return reduce(DataFrame.unionByName, profiles).orderBy("table_name")


def numeric_summary(
    df: DataFrame, columns: Sequence[str], digits: int | None = None
) -> DataFrame:
    """Minimum, maximum and mean per column in one scan: column_name, minimum, maximum, average.

    Extremes keep the columns' type where all share one, so that large integers stay exact; else
    they are doubles.
    """
    require_columns(df, columns)
    kinds = {df.schema[c].dataType.simpleString() for c in columns}
    target = kinds.pop() if len(kinds) == 1 else "double"
    aggregates = []
    for c in columns:
        average = F.avg(c) if digits is None else F.round(F.avg(c), digits)
        aggregates.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.min(c).cast(target).alias("minimum"),
                F.max(c).cast(target).alias("maximum"),
                average.alias("average"),
            )
        )
    return df.agg(F.array(*aggregates).alias("lines")).select(F.inline("lines"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("total")).orderBy(column)


def grouped_summary(
    df: DataFrame,
    by: str,
    averages: Sequence[str] = (),
    extremes: Sequence[str] = (),
    digits: int = 2,
) -> DataFrame:
    """Rows per group with rounded means of some columns and min/max of others."""
    require_columns(df, [by, *averages, *extremes])
    return (
        df.groupBy(by)
        .agg(
            F.count("*").alias("total"),
            *(F.round(F.avg(c), digits).alias(f"avg_{c}") for c in averages),
            *(F.min(c).alias(f"min_{c}") for c in extremes),
            *(F.max(c).alias(f"max_{c}") for c in extremes),
        )
        .orderBy(by)
    )


def share_of_total(df: DataFrame, column: str, order: Sequence = ()) -> DataFrame:
    """Count and unrounded percentage per value; NULL is a value of its own.

    The total is a scalar subquery over the counted groups, so no task sees all groups.
    Values come in the given order, unlisted ones after them.
    """
    counts = df.groupBy(column).agg(F.count("*").alias("total"))
    whole = counts.agg(F.sum("total")).scalar()
    shares = counts.withColumn("percentage", F.col("total") / whole * 100)
    return shares.orderBy(value_rank(column, order), F.col(column).asc_nulls_last())


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first n rows in a stated order (n = 10 by default): a report, not a filter."""
    return df.orderBy(*order).limit(n)
