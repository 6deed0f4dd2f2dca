"""Delimited text in: columns by header name, explicit types, nothing inferred from values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandscope.functions.casts import to_type
from bandscope.sources.contract import require_columns

# Quotes inside a quoted field are doubled, as spreadsheets and dataframe libraries write them.
DIALECT = {"header": True, "quote": '"', "escape": '"'}
MALFORMED = "_malformed"


def read_text_csv(
    spark: SparkSession, path: str, malformed: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Every column of a CSV as a string, named by the header.

    The header of every file must agree, or the read fails. With ``malformed`` the text of rows
    with too few or too many fields is kept in a column of that name. ``multi_line`` reads quoted
    fields that hold line ends; a file is then read by one task, so large data should lie in many.
    """
    reader = spark.read.options(**DIALECT).options(enforceSchema=False, multiLine=multi_line)
    if malformed is None:
        return reader.csv(path)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, malformed]])
    return (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", malformed)
        # A pruned parse would not see how many fields a row has.
        .option("columnPruning", False)
        .csv(path)
    )


def nullified(name: str, null_tokens: Sequence[str]) -> Column:
    # The reader itself turns an empty field into NULL; "" here also covers a quoted empty one.
    value = F.col(f"`{name}`")
    return F.when(~value.isin(*null_tokens), value) if null_tokens else value


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_tokens: Sequence[str] = ("",),
    keep_others: bool = False,
    multi_line: bool = False,
    malformed: str | None = None,
) -> DataFrame:
    """The columns of schema, found by header name and cast; malformed values become NULL.

    Fields equal to one of null_tokens are NULL. Words such as None stay text unless listed.
    ``keep_others`` also returns the columns the schema does not name, as strings. Rows with too few
    fields are filled with NULL and surplus fields are dropped; ``malformed`` names a column that
    keeps the text of such rows, and csv_rejects counts them.
    """
    text = require_columns(read_text_csv(spark, path, malformed, multi_line), schema.names)
    typed = {f.name: to_type(nullified(f.name, null_tokens), f.dataType) for f in schema.fields}
    names = text.columns if keep_others else [*schema.names, *([malformed] if malformed else [])]
    return text.select(
        *(typed[n].alias(n) if n in typed else nullified(n, null_tokens).alias(n) for n in names)
    )


def csv_rejects(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_tokens: Sequence[str] = ("",),
    multi_line: bool = False,
) -> DataFrame:
    """What read_csv turned into NULL: column_name, rejected, in one scan.

    The line named ``*`` counts rows with the wrong number of fields.
    """
    text = require_columns(read_text_csv(spark, path, MALFORMED, multi_line), schema.names)
    lines = [("*", F.count_if(F.col(MALFORMED).isNotNull()))]
    for f in schema.fields:
        value = nullified(f.name, null_tokens)
        lines.append((f.name, F.count_if(value.isNotNull() & to_type(value, f.dataType).isNull())))
    return text.agg(
        F.array(
            *(F.struct(F.lit(n).alias("column_name"), c.alias("rejected")) for n, c in lines)
        ).alias("lines")
    ).select(F.inline("lines"))


def write_csv(df: DataFrame, path: str, multi_line: bool = False) -> None:
    """A folder of CSV parts with headers, values unchanged by trimming.

    Text with a line end fails the write, because readers cut such rows in two unless told otherwise;
    ``multi_line`` allows it, for files that are read with it too.
    """
    if not multi_line:
        df = df.select(*(one_line(f) for f in df.schema.fields))
    (
        df.write.mode("overwrite")
        .options(**DIALECT)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def one_line(field: T.StructField) -> Column:
    """The column, failing on text that holds a line end."""
    value = F.col(f"`{field.name}`")
    if field.dataType.typeName() != "string":
        return value
    message = f"column {field.name} holds a line end; write and read it with multi_line=True"
    broken = value.contains("\n") | value.contains("\r")
    return F.when(broken, F.raise_error(F.lit(message)).cast("string")).otherwise(value).alias(field.name)
