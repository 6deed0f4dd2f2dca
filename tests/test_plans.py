"""What Spark will run: scans, pushdown, aggregation kind, shuffles, skew handling."""

import re

import pytest

import __spark_entry__ as contract
from bandscope import BandSpec, Dimension
from bandscope.operators.mart import build_mart
from bandscope.plans import orders, students
from bandscope.sources.layers import publish

NO_PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan adaptive execution ended with, after running df."""
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


def scans(text: str) -> list[str]:
    return re.findall(r"FileScan parquet .*?\[([^\]]*)\]", text)


def test_scorecard_is_one_pass(spark, sf):
    text = plan(orders.scorecard(spark, sf))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
    assert not any(node in text for node in NO_PYTHON)
    tables = [re.sub(r"_.*", "", s) for s in scans(text)]
    # lineitem and orders once; customer once for its columns and once for its key check
    assert tables.count("l") == 1 and tables.count("o") == 1
    lineitem = next(s for s in scans(text) if s.startswith("l_"))
    assert len(lineitem.split(",")) == 5  # the key and four measures of eleven columns


@pytest.mark.parametrize("name", list(contract.analysis_sql()))
def test_no_python_and_no_cross_join(spark, sf_small, name):
    text = plan(contract.queries()[name](spark, sf_small))
    assert not any(node in text for node in NO_PYTHON)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_filters_reach_the_scan(spark, sf):
    text = plan(orders.pairs(spark, sf))
    assert "IsNotNull(o_totalprice)" in text and "IsNotNull(c_acctbal)" in text
    assert len(scans(text)) == 2 and all(len(s.split(",")) == 2 for s in scans(text))


def test_bucketed_tables_join_without_a_shuffle(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    base = spark.range(2000).selectExpr("cast(id as string) as k", "'A' as grade", "id as v")
    fact = publish(base.select("k", "grade"), "default.b_fact", bucket_by="k", buckets=4)
    one = publish(base.select("k", "v"), "default.b_one", bucket_by="k", buckets=4)
    two = publish(
        base.selectExpr("k", "v * 2 as w"), "default.b_two", bucket_by="k", buckets=4
    )
    bands = BandSpec({"High": ("A",), "Low": ()}, default="Low")
    mart = build_mart(
        fact,
        [
            Dimension("one", one, "k", "k", ["v"], unique=True),
            Dimension("two", two, "k", "k", ["w"], unique=True),
        ],
        bands,
        "grade",
    )
    assert "Exchange" not in plan(mart) and plan(mart).count("SortMergeJoin") == 2
    checked = build_mart(fact, [Dimension("one", one, "k", "k", ["v"])], bands, "grade")
    # the key check of a bucketed table counts each bucket in place
    assert "Exchange hashpartitioning" not in plan(checked)
    assert checked.count() == 2000


def test_a_hot_key_is_named(spark):
    rows = spark.range(900).selectExpr("if(id % 3 = 0, NULL, cast(id as string)) as k", "id as v")
    with pytest.raises(ValueError, match="key k = None has 300 of 900 rows"):
        publish(rows, "default.b_hot", bucket_by="k", buckets=4, check_keys=True)
    publish(rows.where("k IS NOT NULL"), "default.b_even", bucket_by="k", buckets=4, check_keys=True)
    publish(rows, "default.b_asked", bucket_by="k", buckets=4)
    for name in ("b_even", "b_asked"):
        described = spark.sql(f"DESCRIBE EXTENDED default.{name}")
        assert described.where("col_name = 'Num Buckets'").count() == 1
    assert spark.table("default.b_asked").count() == 900


FACTS_ONLY = ["cohort_mean_price", "cohort_rate_status_eq", "grouped_summary_two_avgs", "measure_by_band"]


@pytest.mark.parametrize("name", FACTS_ONLY)
def test_unused_dimensions_are_not_read(spark, sf, name):
    read = {s.split("_")[0] for s in scans(plan(orders.QUERIES[name](spark, sf)))}
    assert "c" not in read and "o" in read
    if name in ("cohort_mean_price", "cohort_rate_status_eq"):
        assert read == {"o"}


def test_a_joined_dimension_is_still_checked(spark):
    fact = spark.createDataFrame([("a", "A")], "k string, grade string")
    dim = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    bands = BandSpec({"High": ("A",), "Low": ()}, default="Low")
    one = Dimension("one", dim, "k", "k", ["v"])
    with pytest.raises(Exception, match="key k is not unique"):
        build_mart(fact, [one], bands, "grade", columns=["v"]).collect()
    assert build_mart(fact, [one], bands, "grade", columns=["k"]).collect()[0].band == "High"
    assert build_mart(fact, [one], bands, "grade", columns=["k"], allow_fan_out=True).count() == 2


def test_preview_joins_ten_orders(spark, sf):
    df = orders.preview(spark, sf)
    assert df.count() == 10
    text = plan(df)
    semi = text[: text.index("l_orderkey")]
    assert "TakeOrderedAndProject" in text and "LeftSemi" in text and semi is not None


def test_hot_key_in_chained_joins_is_split(spark, conf):
    """A third of the facts share one key, and both dimensions join on that key."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    fact = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) as k", "'A' as grade", "id as payload"
    )
    dim = spark.range(60_000).selectExpr("if(id = 0, 'hot', cast(id as string)) as k", "id as v")
    bands = BandSpec({"High": ("A",), "Low": ()}, default="Low")
    mart = build_mart(
        fact,
        [
            Dimension("one", dim, "k", "k", ["v"], unique=True),
            Dimension("two", dim.selectExpr("k", "v as w"), "k", "k", ["w"], unique=True),
        ],
        bands,
        "grade",
    )
    text = final_plan(mart)
    assert text.count("skew=true") >= 2
    assert mart.count() == 60_000


def test_students_mart_reads_no_personal_columns(spark):
    schema = ", ".join(f"{f.name.replace(' (%)', '')} string" for f in students.SOURCE.fields if "(1" not in f.name)
    bronze = spark.createDataFrame([], schema + ", Stress_Level string")
    from bandscope.operators.star import behaviour_dim, entity_dim, fact_rows
    from pyspark.sql import functions as F

    star = {
        "entity": entity_dim(bronze, students.STAR),
        "behaviour": behaviour_dim(bronze, students.STAR),
        "fact": fact_rows(bronze, students.STAR).withColumn("ID_Disciplina", F.lit("1")),
    }
    assert not set(students.students_mart(star).columns) & set(students.PERSONAL)
