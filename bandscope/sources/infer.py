"""Types of delimited text, told from all of its values.

Every column is counted by the types its values fit, in one scan and one aggregation. The counts are additive, so profiles of
further files are added to those there are, and a column's type follows from the counts alone: the
narrowest type that all values fit. No sample is drawn, and no value outside it can come as a surprise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandscope.sources.csv import nullified, read_csv, read_text_csv

# From narrow to wide, each with how its values are written. A value must fit the pattern and the type, so that
# "1d", " 7" or "yes" stay text. An int is also a long and a double, a date also a timestamp.
LATTICE = {
    "boolean": r"(?i)^(true|false)$",
    "int": r"^[+-]?[0-9]{1,10}$",
    "bigint": r"^[+-]?[0-9]{1,19}$",
    "double": r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp_ntz": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$",
}
WIDEST = "string"
COUNTS = ["rows", "nulls", *(f"fits_{t}" for t in LATTICE)]


def fits(value: Column, kind: str) -> Column:
    return value.rlike(LATTICE[kind]) & value.try_cast(kind).isNotNull()


def type_profile(text: DataFrame, null_tokens: Sequence[str] = ("",)) -> DataFrame:
    """Per column of a table of strings: column_name, position, rows, nulls, and how many values fit each type.

    Fields equal to one of null_tokens count as null, and fit nothing. One scan, whatever the columns.
    """
    lines = []
    for position, name in enumerate(text.columns):
        value = nullified(name, null_tokens)
        counts = [F.count("*"), F.count_if(value.isNull()), *(F.count_if(fits(value, t)) for t in LATTICE)]
        named = [c.alias(n) for c, n in zip(counts, COUNTS, strict=True)]
        lines.append(F.struct(F.lit(name).alias("column_name"), F.lit(position).alias("position"), *named))
    if not lines:
        return text.sparkSession.createDataFrame([], f"column_name string, position int, {', '.join(f'{c} bigint' for c in COUNTS)}")
    return text.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def merge_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all rows behind the given ones, by column name. A column that one lacks keeps the others' counts."""
    merged = reduce(DataFrame.unionByName, profiles).groupBy("column_name")
    return merged.agg(F.min("position").alias("position"), *(F.sum(c).alias(c) for c in COUNTS))


def profile_type(profile: DataFrame) -> DataFrame:
    """column_name, type, rows, nulls and n_fit of each column of a profile, in the table's order.

    n_fit counts the values that fit the type, which is all of them. A column without a value is text.
    """
    values = F.col("rows") - F.col("nulls")
    kind, n = F, F
    for t in LATTICE:
        whole = (values > 0) & (F.col(f"fits_{t}") == values)
        kind, n = kind.when(whole, F.lit(t)), n.when(whole, F.col(f"fits_{t}"))
    return profile.orderBy("position", "column_name").select(
        "column_name", kind.otherwise(F.lit(WIDEST)).alias("type"), "rows", "nulls", n.otherwise(values).alias("n_fit")
    )


def schema_from(profile: DataFrame) -> T.StructType:
    """The schema a profile tells. One row a column comes to the driver."""
    told = profile_type(profile).collect()
    return T.StructType([T.StructField(r["column_name"], T.DataType.fromDDL(r["type"])) for r in told])


def infer_schema(
    spark: SparkSession, path: str, null_tokens: Sequence[str] = ("",), multi_line: bool = False
) -> T.StructType:
    """The schema of a CSV, from all of its values."""
    return schema_from(type_profile(read_text_csv(spark, path, multi_line=multi_line), null_tokens))


def read_inferred_csv(
    spark: SparkSession, path: str, null_tokens: Sequence[str] = ("",), multi_line: bool = False
) -> DataFrame:
    """A CSV with the types its values tell. Reads the text once to learn the types and once for the rows."""
    return read_csv(spark, path, infer_schema(spark, path, null_tokens, multi_line), null_tokens, multi_line=multi_line)
