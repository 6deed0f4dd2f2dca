import pytest

from bandscope.operators import bitmaps, keys
from bandscope.plans import orders
from bandscope.sources.layers import column_statistics, publish
from bandscope.spec import Dimension


def both(fact, dims):
    wanted = sorted(map(tuple, keys.key_report(fact, dims).collect()))
    return sorted(map(tuple, bitmaps.key_report_by_bitmaps(fact, dims).collect())), wanted


def test_faults_of_every_kind(spark):
    fact = spark.createDataFrame([(k,) for k in [1, 1, 2, 70_000, 70_001, -5, -40_000, None, None, 2**62]], "k long")
    clean = Dimension("clean", spark.range(-50_000, 100_000).selectExpr("id AS d"), "d", "k", [])
    odd = Dimension("odd", spark.createDataFrame([(k,) for k in [1, 1, 1, 2, 2, -5, None, 70_000, 2**62, -(2**62)]], "d long"), "d", "k", [])
    none = Dimension("none", spark.createDataFrame([], "d int"), "d", "k", [])
    got, wanted = both(fact, [clean, odd, none])
    assert got == wanted
    assert both(fact.limit(0), [clean, odd, none])[0] == both(fact.limit(0), [clean, odd, none])[1]


def test_only_suspect_buckets_are_counted_by_key(spark):
    fact = spark.range(200_000).selectExpr("id AS k")
    dim = spark.range(200_000).where("id <> 150000").selectExpr("id AS d").unionAll(spark.createDataFrame([(3,)], "d long"))
    suspects = bitmaps.suspect_buckets(fact, Dimension("d", dim, "d", "k", [])).collect()
    # Buckets are numbered from 1, each of 32,768 keys.
    assert sorted(r.bucket for r in suspects) == [1, 150_000 // 32_768 + 1]


def test_keys_that_are_no_whole_numbers_are_refused(spark):
    text = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError, match="no whole number"):
        bitmaps.key_report_by_bitmaps(text, [Dimension("d", text, "k", "k", [])])


def test_statistics_of_a_published_table(spark):
    rows = [(1, "a", 2.5), (2, "b", None), (3, None, 1.5)]
    publish(spark.createDataFrame(rows, "k int, t string, x double"), "default.analysed", analyze=True)
    got = {r.column_name: tuple(r)[1:] for r in column_statistics(spark, "default.analysed").collect()}
    assert got == {"k": ("int", "1", "3", 0, 3), "t": ("string", None, None, 1, 2), "x": ("double", "1.5", "2.5", 1, 2)}
    publish(spark.createDataFrame(rows, "k int, t string, x double"), "default.not_analysed")
    assert {tuple(r)[2:] for r in column_statistics(spark, "default.not_analysed").collect()} == {(None, None, None, None)}


def test_statistics_change_the_plan(spark, sf, conf):
    """A filter that the statistics know to leave little makes its side small enough to broadcast."""
    lines = orders.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    whole = orders.table(spark, sf, "orders")
    conf(spark__sql__cbo__enabled="true", spark__sql__autoBroadcastJoinThreshold="20000", spark__sql__adaptive__enabled="false")
    plans = {}
    for analyze in (False, True):
        few = publish(lines, "default.analysed_lines", analyze=analyze).where("l_partkey = 77")
        joined = whole.join(few, few["l_orderkey"] == whole["o_orderkey"])
        plans[analyze] = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plans[False] and "BroadcastHashJoin" in plans[True]
