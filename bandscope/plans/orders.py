"""The same analysis over the driver's order tables.

An order is the fact row, its customer the entity, its line items (per order) the behaviour,
the market segment the category and the order priority the grade.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandscope.operators import bitmaps, cohort, distribution, heavy, keys, ledger, profile
from bandscope.operators.mart import build_mart, entity_measure_pairs, refuse_duplicates
from bandscope.operators.star import behaviour_dim, entity_dim, fact_rows, split_star
from bandscope.session import scratch_path, stored
from bandscope.sources.csv import csv_rejects, read_csv, read_text_csv, write_csv
from bandscope.sources import infer
from bandscope.sources.layers import (
    column_statistics,
    land_bronze,
    normalise_names,
    publish,
    publish_view,
    read_layer,
    register_views,
    write_layer,
)
from bandscope.sources.versions import VersionedFolder, point_view, publish_version
from bandscope.spec import BandSpec, Dimension, StarSpec, mean, rate

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
BANDS = BandSpec({"High": PRIORITIES[:2], "Medium": (), "Low": PRIORITIES[4:]}, default="Medium")
QUALITY = BandSpec({"High": (1,), "Medium": (), "Low": (0,)}, default="Medium")
FACTORS = [
    mean("qty", "qty"),
    mean("price", "o_totalprice"),
    rate("high_discount", "disc >= 0.1"),
    rate("segment_in", "c_mktsegment IN ('AUTOMOBILE', 'BUILDING')"),
    rate("status_f", "o_orderstatus = 'F'"),
    rate("has_return", "has_return = 'Yes'"),
    rate("not_all_filled", "all_filled = 'No'"),
]


# Stated, so that opening a table starts no job to read its footers.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def yes_no(flag: str) -> Column:
    # No otherwise(): a missing flag stays NULL instead of turning into 'No'.
    return F.when(F.col(flag) == 1, "Yes").when(F.col(flag) == 0, "No")


def order_behaviour(lineitem: DataFrame) -> DataFrame:
    """Line items per order. Flags aggregate as 0/1 so that Spark keeps hash aggregation."""
    return (
        lineitem.groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.max("l_discount").alias("disc"),
            F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned"),
            F.min((F.col("l_linestatus") != "O").cast("int")).alias("filled"),
        )
        .select(
            "l_orderkey",
            "qty",
            "disc",
            yes_no("returned").alias("has_return"),
            yes_no("filled").alias("all_filled"),
        )
    )


def order_dimensions(spark: SparkSession, sf_dir: str) -> list[Dimension]:
    return [
        Dimension(
            "customer", table(spark, sf_dir, "customer"), "c_custkey", "o_custkey", ["c_mktsegment"]
        ),
        Dimension(
            "behaviour",
            order_behaviour(table(spark, sf_dir, "lineitem")),
            "l_orderkey",
            "o_orderkey",
            ["qty", "disc", "has_return", "all_filled"],
            unique=True,
        ),
    ]


FACT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
CASTS = {"o_totalprice": "double", "qty": "double", "disc": "double"}


def order_mart(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The wide mart, or the given columns of it, for which only the tables that have them are read."""
    fact = table(spark, sf_dir, "orders").select(*FACT)
    dimensions = order_dimensions(spark, sf_dir)
    return build_mart(fact, dimensions, BANDS, "o_orderpriority", CASTS, columns=columns)


# Cohort reports


def scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.factor_scorecard(order_mart(spark, sf_dir), FACTORS, BANDS)


def scorecard_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.cohort_report(order_mart(spark, sf_dir), FACTORS, BANDS)


def mean_of(name: str, column: str):
    return lambda spark, sf_dir: cohort.cohort_mean(
        order_mart(spark, sf_dir, [column]), name, column, BANDS
    )


def rate_of(name: str, column: str):
    """The factor's rate; its predicate reads this column alone."""
    predicate = next(f.expr for f in FACTORS if f.name == name)
    return lambda spark, sf_dir: cohort.cohort_rate(
        order_mart(spark, sf_dir, [column]), name, predicate, BANDS
    )


def gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.factor_gap(scorecard(spark, sf_dir), "Low", "High")


def documents_with_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most documents have no label, so most grades are NULL."""
    labels = Dimension("labels", table(spark, sf_dir, "labels"), "doc_id", "doc_id", ["quality"])
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return build_mart(documents, [labels], QUALITY, grade="quality")


def band_with_null_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = [rate("english", "lang = 'en'"), mean("chars", "n_chars")]
    return cohort.cohort_report(documents_with_quality(spark, sf_dir), factors, QUALITY)


# Star tables, from a flat table like the one a study starts with

STAR = StarSpec(
    key="o_orderkey",
    key_alias="entity_id",
    entity={"c_name": "name", "c_nationkey": "nation", "c_acctbal": "balance"},
    behaviour={"qty": "qty", "disc": "disc", "has_return": "has_return", "all_filled": "all_filled"},
    category="c_mktsegment",
    category_alias="segment",
    category_id="segment_id",
    fact={"o_totalprice": "price", "o_orderstatus": "status", "o_orderpriority": "priority"},
)
FLAT = T.StructType(
    [
        T.StructField("o_orderkey", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
        T.StructField("qty", T.DoubleType()),
        T.StructField("disc", T.DoubleType()),
        T.StructField("has_return", T.StringType()),
        T.StructField("all_filled", T.StringType()),
    ]
)
STAR_FACTORS = [
    mean("qty", "qty"),
    mean("price", "price"),
    rate("high_discount", "disc >= 0.1"),
    rate("segment_in", "segment IN ('AUTOMOBILE', 'BUILDING')"),
    rate("status_f", "status = 'F'"),
    rate("has_return", "has_return = 'Yes'"),
    rate("not_all_filled", "all_filled = 'No'"),
]


def flat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    behaviour = order_behaviour(table(spark, sf_dir, "lineitem"))
    return (
        orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
        .join(behaviour, orders["o_orderkey"] == behaviour["l_orderkey"], "left")
        .select(*FLAT.names)
    )


def star_mart(star: dict[str, DataFrame], unique: bool = False) -> DataFrame:
    key = STAR.key_alias
    return build_mart(
        star["fact"],
        [
            Dimension("entity", star["entity"], key, key, ["nation", "balance"], unique),
            Dimension("behaviour", star["behaviour"], key, key, list(STAR.behaviour.values()), unique),
        ],
        BANDS,
        grade="priority",
        casts={"price": "double", "qty": "double", "disc": "double", "nation": "int"},
    )


def star_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_dim(flat_orders(spark, sf_dir), STAR)


def star_behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour_dim(flat_orders(spark, sf_dir), STAR)


def star_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_rows(flat_orders(spark, sf_dir), STAR)


def star_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart rebuilt from the split star: segment ids resolved, both dimensions joined back.

    The flat key is checked once; the dimensions cut from it need no check of their own.

    The flat table is stored first, as a landed bronze table would be: the star tables read it
    instead of each repeating its joins.
    """
    flat = stored(flat_orders(spark, sf_dir), "flat")
    star = split_star(flat, STAR)
    star["fact"] = refuse_duplicates(star["fact"], Dimension("flat", flat, STAR.key, STAR.key, []))
    return star_mart(star, unique=True).select(
        "entity_id", "segment_id", "segment", "price", "priority", "nation", "qty", "band"
    )


def layered_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV to bronze to silver to mart to scorecard, each layer written and read back."""
    raw, bronze, silver = (scratch_path(spark, n) for n in ("raw", "bronze", "silver"))
    write_csv(flat_orders(spark, sf_dir), raw)
    landed = land_bronze(spark, raw, bronze, FLAT)
    write_layer(split_star(landed, STAR), silver)
    star = read_layer(spark, silver, ["entity", "behaviour", "category", "fact"])
    return cohort.factor_scorecard(star_mart(star), STAR_FACTORS, BANDS)


def published_mart(
    spark: SparkSession,
    sf_dir: str,
    name: str = "bandscope_order_mart",
    view: str = "bandscope_order_mart_with_band",
    database: str = "default",
) -> DataFrame:
    """The mart saved as a managed table and read through its view."""
    publish(order_mart(spark, sf_dir), f"{database}.{name}")
    return publish_view(spark, f"{database}.{view}", f"{database}.{name}")


def published_versions(
    spark: SparkSession, sf_dir: str, view: str = "bandscope_versioned_mart", database: str = "default"
) -> DataFrame:
    """The mart published twice, first without the finished orders: the version before, the current one, and the view."""
    root = scratch_path(spark, "versions")
    mart = order_mart(spark, sf_dir)
    publish_version(mart.filter("o_orderstatus <> 'F'"), root, f"{database}.{view}")
    last = publish_version(mart, root, f"{database}.{view}")
    folder = VersionedFolder(spark, root)
    kept = [folder.read(n).withColumn("version", F.lit(str(n))) for n in (last.number - 1, last.number)]
    seen = point_view(spark, root, f"{database}.{view}").withColumn("version", F.lit("view"))
    return kept[0].unionByName(kept[1]).unionByName(seen)


def scorecard_from_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard from a state kept by three batches of orders, the second sent twice.

    The first batch has every order that ends in 0 with a price too high by a tenth; the third takes these rows back.
    """
    root = scratch_path(spark, "scorecard-state")
    mart = order_mart(spark, sf_dir)
    early, wrong = F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") % 10 == 0
    first = mart.filter(early)
    priced = first.withColumn("o_totalprice", F.when(wrong, F.col("o_totalprice") * 1.1).otherwise(F.col("o_totalprice")))
    gone, anew = priced.filter(wrong), first.filter(wrong)
    revised = gone.withColumn("sign", F.lit(-1)).unionByName(anew.withColumn("sign", F.lit(1)))
    ledger.commit_batch(root, "monday", ledger.partial_scorecard(priced, FACTORS))
    for _ in range(2):
        ledger.commit_batch(root, "tuesday", ledger.partial_scorecard(mart.filter(~early), FACTORS))
    ledger.commit_batch(root, "wednesday", ledger.partial_scorecard(revised, FACTORS, F.col("sign")))
    return ledger.scorecard_from_state(ledger.scorecard_state(spark, root), FACTORS, BANDS)


def published_statistics(
    spark: SparkSession, sf_dir: str, name: str = "bandscope_analysed_mart", database: str = "default"
) -> DataFrame:
    """What the catalog knows of the published mart: nulls and distinct values of the columns with few of them."""
    publish(order_mart(spark, sf_dir), f"{database}.{name}", analyze=True)
    few = ["o_orderstatus", "o_orderpriority", "c_mktsegment", "has_return", "all_filled", "band"]
    known = column_statistics(spark, f"{database}.{name}")
    return known.where(F.col("column_name").isin(few)).select("column_name", "type", "nulls", "distinct_values")


def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session views joined by SQL with aliases and a derived table."""
    register_views({f"bandscope_{n}": table(spark, sf_dir, n) for n in ("customer", "orders")})
    return spark.sql(
        """
        SELECT c.c_mktsegment AS segment, p.priority, count(*) AS n_orders, max(p.price) AS top_price
        FROM bandscope_customer AS c
        JOIN (SELECT o.o_custkey AS custkey, o.o_orderpriority AS priority, o.o_totalprice AS price
              FROM bandscope_orders AS o WHERE o.o_totalprice IS NOT NULL) AS p ON p.custkey = c.c_custkey
        GROUP BY c.c_mktsegment, p.priority"""
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return keys.category_dim(customer, "c_mktsegment", "segment", "segment_id")


def category_dim_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types numbered over two loads, the small sizes first; the second load is sent twice."""
    root = scratch_path(spark, "type-ids")
    part = table(spark, sf_dir, "part")
    ledger.grow_category_dim(root, "small", part.filter("p_size <= 3"), "p_type", "part_type", "type_id")
    for _ in range(2):
        grown = ledger.grow_category_dim(root, "all", part, "p_type", "part_type", "type_id")
    return grown


def order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category dimension as large as its table."""
    return keys.category_dim(table(spark, sf_dir, "orders"), "o_orderkey", "order_key", "order_id")


def fact_fk_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most documents have no label: NULL is no category, and has no id."""
    graded = documents_with_quality(spark, sf_dir).select("doc_id", "quality")
    dimension = keys.category_dim(graded, "quality", "quality", "quality_id")
    return keys.resolve_fk(graded, dimension, "quality", "quality", "quality_id")


def segments_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return keys.category_dim_hash(customer, "c_mktsegment", "segment", "segment_id")


def fact_fk_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    named = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left").select(
        "o_orderkey", "o_totalprice", F.col("c_mktsegment").alias("segment")
    )
    return keys.resolve_fk(named, segments(spark, sf_dir), "segment", "segment", "segment_id")


def key_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_lines = Dimension(
        "lineitem", table(spark, sf_dir, "lineitem"), "l_orderkey", "o_orderkey", []
    )
    return keys.key_report(
        table(spark, sf_dir, "orders"), [*order_dimensions(spark, sf_dir), raw_lines]
    )


def key_report_by_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    dimensions = [*order_dimensions(spark, sf_dir), Dimension("lineitem", lines, "l_orderkey", "o_orderkey", [])]
    return bitmaps.key_report_by_bitmaps(orders, dimensions)


def key_report_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.struct("l_orderkey", "l_linenumber").alias("line")
    )
    return keys.key_report(lines, [Dimension("line", lines, "line", "line", [])])


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = normalise_names(table(spark, sf_dir, "orders"), {"o_custkey": "c_custkey"})
    return entity_measure_pairs(
        table(spark, sf_dir, "customer"), orders, "c_custkey", "c_acctbal", "o_totalprice"
    )


# Profiles


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_counts(
        {
            "customer": table(spark, sf_dir, "customer"),
            "lineitem": table(spark, sf_dir, "lineitem"),
            "orders": table(spark, sf_dir, "orders"),
            "segment": table(spark, sf_dir, "customer").select("c_mktsegment").distinct(),
        }
    )


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderkey", "c_mktsegment", "qty", "has_return"]
    return profile.null_profile(order_mart(spark, sf_dir), columns, "mart")


def cell_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.cell_profile(
        {
            "customer": table(spark, sf_dir, "customer"),
            "mart": order_mart(spark, sf_dir).select("qty", "disc", "c_mktsegment"),
        }
    )


def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_summary(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_linenumber", "l_suppkey"]
    )


def numeric_summary_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_summary(
        table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_discount"], digits=2
    )


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(table(spark, sf_dir, "part"), "p_size")


def value_counts_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most ordered parts: a top-k report over a key with many values."""
    return heavy.top_values(table(spark, sf_dir, "lineitem"), "l_partkey", 25)


def grouped_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.grouped_summary(
        table(spark, sf_dir, "customer"), "c_mktsegment", ["c_acctbal"], ["c_acctbal"]
    )


def grouped_summary_two_avgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = order_mart(spark, sf_dir, ["o_orderpriority", "o_totalprice", "qty"])
    return profile.grouped_summary(mart, "o_orderpriority", ["o_totalprice", "qty"])


def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.share_of_total(table(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES)


def share_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.share_of_total(documents_with_quality(spark, sf_dir), "quality", (1, 0))


def preview(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    """The first orders of the mart. No dimension repeats a key, so the fact is cut to n rows before the joins."""
    first = profile.preview(table(spark, sf_dir, "orders").select(*FACT), ["o_orderkey"], n)
    chosen = F.broadcast(first.select(F.col("o_orderkey").alias("l_orderkey")))
    customer, behaviour = order_dimensions(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").join(chosen, "l_orderkey", "left_semi")
    behaviour = replace(behaviour, frame=order_behaviour(lines))
    mart = build_mart(first, [customer, behaviour], BANDS, "o_orderpriority", CASTS)
    return mart.orderBy("o_orderkey")


def preview_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.preview(table(spark, sf_dir, "customer"), ["c_custkey"], 5)


# Distributions


def histogram_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.histogram(table(spark, sf_dir, "orders"), ["o_totalprice"])


def histogram_acctbal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.histogram(table(spark, sf_dir, "customer"), ["c_acctbal"])


def histogram_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.histogram(pairs(spark, sf_dir), ["c_acctbal", "o_totalprice"])


def rounded_box(stats: DataFrame) -> DataFrame:
    """Interpolated values differ between engines in the last bit."""
    interpolated = ["q1", "median", "q3", "fence_low", "fence_high", "whisker_low", "whisker_high"]
    return stats.withColumns({c: F.round(c, 6) for c in interpolated})


def quantity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.measure_by_band(order_mart(spark, sf_dir, ["qty"]), "qty")


def box_stats_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored first: box_stats reads its rows more than once, and here they come from joins."""
    quantity = stored(quantity_rows(spark, sf_dir), "quantity")
    return rounded_box(distribution.box_stats(quantity, "band", "qty"))


def box_stats_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A continuous measure: nearly every value is distinct."""
    lines = table(spark, sf_dir, "lineitem")
    return rounded_box(distribution.box_stats(lines, "l_returnflag", "l_extendedprice"))


def box_stats_many_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many groups as suppliers."""
    lines = table(spark, sf_dir, "lineitem")
    return rounded_box(distribution.box_stats(lines, "l_suppkey", "l_quantity"))


def outlier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored first, for the same reason."""
    quantity = stored(order_mart(spark, sf_dir, ["o_orderkey", "qty"]), "quantity")
    return distribution.outliers(quantity, "band", "qty")


# The same results by the way that groups of a million rows and more take.
RANKED = {"large": 1, "size": 1000}


def box_stats_price_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return rounded_box(distribution.box_stats(lines, "l_returnflag", "l_extendedprice", **RANKED))


def box_stats_many_groups_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return rounded_box(distribution.box_stats(lines, "l_suppkey", "l_quantity", **RANKED))


def outlier_rows_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = stored(order_mart(spark, sf_dir, ["o_orderkey", "qty"]), "quantity")
    return distribution.outliers(quantity, "band", "qty", **RANKED)


# Ingest


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer-csv")
    write_csv(customer, path)
    return read_csv(spark, path, customer.schema)


def csv_all_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "part-csv")
    write_csv(table(spark, sf_dir, "part"), path)
    return read_text_csv(spark, path)


def csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line ends and quotes, written and read back."""
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "documents-csv")
    write_csv(documents, path, multi_line=True)
    return read_csv(spark, path, documents.schema, multi_line=True)


def orders_with_bad_prices(spark: SparkSession, sf_dir: str) -> str:
    """A CSV of the orders whose price is unreadable for one status and absent for one priority."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    price = (
        F.when(F.col("o_orderstatus") == "P", "unknown")
        .when(F.col("o_orderpriority") == "5-LOW", "NA")
        .otherwise(F.col("o_totalprice").cast("string"))
    )
    path = scratch_path(spark, "orders-csv")
    write_csv(orders.withColumn("o_totalprice", price), path)
    return path


PRICE_CONTRACT = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)


def orders_as_text(spark: SparkSession, sf_dir: str) -> str:
    """A CSV with a column of each type, columns that nearly have one, and one without a value."""
    path = scratch_path(spark, "typed-csv")
    key = F.col("o_orderkey")
    write_csv(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            (key * 5_000_000_000).alias("wide_key"),
            "o_totalprice",
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("moment"),
            (F.col("o_orderstatus") == "F").cast("string").alias("finished"),
            "o_orderpriority",
            F.when(key % 1000 == 7, "n/a").otherwise(key.cast("string")).alias("nearly_key"),
            F.when(key % 3 == 0, F.lit("NA")).otherwise(F.col("o_totalprice").cast("string")).alias("some_price"),
            F.lit(None).cast("string").alias("nothing"),
        ),
        path,
    )
    return path


def csv_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = read_text_csv(spark, orders_as_text(spark, sf_dir))
    return infer.profile_type(infer.type_profile(text, ("", "NA")))


def csv_inferred_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer.read_inferred_csv(spark, orders_as_text(spark, sf_dir), ("", "NA"))


def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = orders_with_bad_prices(spark, sf_dir)
    return read_csv(spark, path, PRICE_CONTRACT, null_tokens=("", "NA"))


def csv_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = orders_with_bad_prices(spark, sf_dir)
    return csv_rejects(spark, path, PRICE_CONTRACT, null_tokens=("", "NA"))


QUERIES = {
    "factor_scorecard": scorecard,
    "factor_scorecard_wide": scorecard_wide,
    "cohort_mean_qty": mean_of("qty", "qty"),
    "cohort_mean_price": mean_of("price", "o_totalprice"),
    "cohort_rate_high_discount": rate_of("high_discount", "disc"),
    "cohort_rate_segment_in": rate_of("segment_in", "c_mktsegment"),
    "cohort_rate_status_eq": rate_of("status_f", "o_orderstatus"),
    "cohort_rate_has_return": rate_of("has_return", "has_return"),
    "cohort_rate_not_all_filled": rate_of("not_all_filled", "all_filled"),
    "factor_gap": gap,
    "band_with_null_default": band_with_null_default,
    "measure_by_band": quantity_rows,
    "mart_rows": order_mart,
    "published_mart": published_mart,
    "published_versions": published_versions,
    "published_statistics": published_statistics,
    "scorecard_from_batches": scorecard_from_batches,
    "sql_views": sql_views,
    "star_entity_dim": star_entity,
    "star_behaviour_dim": star_behaviour,
    "star_fact": star_fact,
    "star_split": star_split,
    "layered_scorecard": layered_scorecard,
    "category_dim": segments,
    "category_dim_large": order_keys,
    "category_dim_hash": segments_hash,
    "category_dim_grown": category_dim_grown,
    "fact_fk_resolved": fact_fk_resolved,
    "fact_fk_null": fact_fk_null,
    "key_report": key_report,
    "key_report_by_bitmaps": key_report_by_bitmaps,
    "key_report_composite": key_report_composite,
    "pairs_inner_notnull": pairs,
    "table_counts": table_counts,
    "null_profile": null_profile,
    "cell_profile": cell_profile,
    "numeric_summary": numeric_summary,
    "numeric_summary_rounded": numeric_summary_rounded,
    "value_counts": value_counts,
    "value_counts_top": value_counts_top,
    "grouped_summary": grouped_summary,
    "grouped_summary_two_avgs": grouped_summary_two_avgs,
    "share_of_total": share_of_total,
    "share_with_null": share_with_null,
    "preview": preview,
    "preview_five": preview_five,
    "histogram_price": histogram_price,
    "histogram_acctbal": histogram_acctbal,
    "histogram_pairs": histogram_pairs,
    "box_stats_qty": box_stats_qty,
    "box_stats_price": box_stats_price,
    "box_stats_many_groups": box_stats_many_groups,
    "outlier_rows": outlier_rows,
    "box_stats_price_large": box_stats_price_large,
    "box_stats_many_groups_large": box_stats_many_groups_large,
    "outlier_rows_large": outlier_rows_large,
    "csv_roundtrip": csv_roundtrip,
    "csv_all_text": csv_all_text,
    "csv_multiline": csv_multiline,
    "csv_inferred_types": csv_inferred_types,
    "csv_inferred_rows": csv_inferred_rows,
    "csv_malformed": csv_malformed,
    "csv_reject_counts": csv_reject_counts,
}


def registry() -> dict:
    return dict(QUERIES)
