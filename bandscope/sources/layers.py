"""Bronze, silver and gold: landing, layer folders, published tables and views."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandscope.session import release
from bandscope.sources.csv import MALFORMED, read_csv, write_csv
from bandscope.sources.infer import infer_schema
from bandscope.sources.swap import recover, swap_in


def normalise_names(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def land_bronze(
    spark: SparkSession,
    source: str,
    destination: str,
    schema: T.StructType | None = None,
    null_tokens: Sequence[str] = ("",),
    renames: Mapping[str, str] | None = None,
    multi_line: bool = False,
    allow_malformed: bool = False,
) -> DataFrame:
    """Land a raw CSV as Parquet with every source column, and read it back.

    Columns named in the schema are typed, the others stay text. A missing source fails here,
    before any work. Rows with too few or too many fields are counted by the scan that lands them;
    if there are some, the landing fails with their number and the destination stays as it was,
    unless ``allow_malformed``. Without a schema the types are those that all values of the source tell.
    The new rows take the place of the old ones by a swap that a crash cannot lose: the next landing
    finishes it (`sources.swap`).
    """
    recover(spark, destination)
    if schema is None:
        schema = infer_schema(spark, source, null_tokens, multi_line)
    raw = read_csv(spark, source, schema, null_tokens, True, multi_line, MALFORMED)
    seen = Observation()
    counted = raw.observe(seen, F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"))
    aside = f"{destination.rstrip('/')}-landing-{uuid.uuid4().hex}"
    normalise_names(counted.drop(MALFORMED), renames or {}).write.parquet(aside)
    if seen.get["malformed"] and not allow_malformed:
        release(spark, aside)
        raise ValueError(f"{source}: {seen.get['malformed']} rows have too few or too many fields")
    swap_in(spark, aside, destination)
    return spark.read.parquet(destination)


def write_layer(tables: Mapping[str, DataFrame], destination: str, fmt: str = "parquet") -> None:
    """Write each table under destination/<name>. The writes run side by side.

    A table is written aside and then swapped in, so the old one stays if a write fails, and a table may be
    made from the one it replaces.
    """

    def write(name: str) -> None:
        path = f"{destination.rstrip('/')}/{name}"
        aside = f"{path}-writing-{uuid.uuid4().hex}"
        try:
            if fmt == "csv":
                write_csv(tables[name], aside)
            else:
                tables[name].write.format(fmt).save(aside)
        except BaseException:
            release(tables[name].sparkSession, aside)
            raise
        swap_in(tables[name].sparkSession, aside, path)

    if tables:
        with ThreadPoolExecutor(len(tables)) as pool:
            list(pool.map(write, tables))


def read_layer(spark: SparkSession, destination: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """The Parquet tables of a layer. A swap that was cut short is finished first."""
    paths = {n: f"{destination.rstrip('/')}/{n}" for n in names}
    for path in paths.values():
        recover(spark, path)
    return {n: spark.read.parquet(path) for n, path in paths.items()}


def refuse_heavy_key(df: DataFrame, key: str, buckets: int) -> None:
    """Fail if one key alone, NULL included, outweighs an even bucket."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    heaviest, total = per_key.agg(F.max_by(F.struct(key, "n"), "n"), F.sum("n")).first()
    if heaviest is not None and heaviest["n"] > max(total // buckets, 1):
        raise ValueError(
            f"key {key} = {heaviest[key]!r} has {heaviest['n']} of {total} rows, more than an even bucket of {buckets}"
        )


def publish(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    path: str | None = None,
    bucket_by: str | None = None,
    buckets: int = 0,
    check_keys: bool = False,
    analyze: bool = False,
) -> DataFrame:
    """Save as a catalog table, replacing it, and return the table.

    With ``bucket_by`` the rows are bucketed and sorted on that key. Tables bucketed alike on
    the entity key join without a shuffle, so the silver tables pay for it once. A bucket is written
    and read by one task, so a key with more rows than an even bucket should not be bucketed on:
    ``check_keys`` reads df once more beforehand and fails if there is one. ``analyze`` collects statistics of
    the table and all its columns afterwards, which Spark's cost-based planning uses and
    `column_statistics` reads.
    """
    if bucket_by is not None and check_keys:
        refuse_heavy_key(df, bucket_by, buckets)
    # One writer task per bucket, so a bucket is one file rather than one per task.
    writer = (df.repartition(buckets, bucket_by) if bucket_by is not None else df).write
    writer = writer.mode("overwrite").format(fmt)
    if bucket_by is not None:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    if analyze:
        df.sparkSession.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    return df.sparkSession.table(table)


STATISTICS = {"min": "minimum", "max": "maximum", "num_nulls": "nulls", "distinct_count": "distinct_values"}


def column_statistics(spark: SparkSession, table: str) -> DataFrame:
    """column_name, type, minimum, maximum, nulls, distinct_values of an analysed table, from the catalog: no row is read.

    Distinct values are estimated by Spark (a few per cent off where there are many). A column that was not
    analysed has NULLs. One short catalog call a column.
    """
    rows = []
    for field in spark.table(table).schema.fields:
        told = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} `{field.name}`").collect()}
        known = {to: None if told.get(name) in (None, "NULL") else told[name] for name, to in STATISTICS.items()}
        counts = [None if known[c] is None else int(known[c]) for c in ("nulls", "distinct_values")]
        rows.append((field.name, field.dataType.simpleString(), known["minimum"], known["maximum"], *counts))
    schema = "column_name string, type string, minimum string, maximum string, nulls bigint, distinct_values bigint"
    return spark.createDataFrame(rows, schema)


def publish_view(spark: SparkSession, view: str, table: str) -> DataFrame:
    """A catalog view over a published table."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")
    return spark.table(view)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Session views for ad-hoc SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
