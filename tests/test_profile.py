import pytest

from bandscope.operators import profile


def test_equal_counts_are_ordered_by_name(spark):
    two = spark.range(2)
    rows = profile.table_counts({"c": two, "a": two, "b": spark.range(3)}).collect()
    assert [tuple(r) for r in rows] == [("b", 3), ("a", 2), ("c", 2)]


def test_nan_is_a_missing_cell_but_not_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None), (None, "y")], "v double, s string")
    assert tuple(profile.null_profile(df, ["v", "s"], "t").first()) == ("t", 3, 1, 1)
    assert tuple(profile.cell_profile({"t": df}).first()) == ("t", 6, 3, 3)


def test_empty_table(spark):
    df = spark.createDataFrame([], "v double, s string")
    assert tuple(profile.table_counts({"t": df}).first()) == ("t", 0)
    assert tuple(profile.cell_profile({"t": df}).first()) == ("t", 0, 0, 0)
    assert tuple(profile.null_profile(df, ["v"], "t").first()) == ("t", 0, 0)
    assert tuple(profile.numeric_summary(df, ["v"]).first()) == ("v", None, None, None)
    assert profile.value_counts(df, "s").collect() == []
    assert profile.grouped_summary(df, "s", ["v"], ["v"]).collect() == []
    assert profile.share_of_total(df, "s").collect() == []


def test_shares_sum_to_hundred_with_null_group_and_order(spark):
    df = spark.createDataFrame([("F",), ("A",), (None,), ("A",), ("z",)], "g string")
    rows = profile.share_of_total(df, "g", ("A", "F")).collect()
    assert [(r.g, r.total) for r in rows] == [("A", 2), ("F", 1), ("z", 1), (None, 1)]
    assert sum(r.percentage for r in rows) == pytest.approx(100)


def test_summaries(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, None), ("b", 6, 4.5)], "g string, i int, v double")
    rows = profile.numeric_summary(df, ["i", "v"], digits=2).collect()
    assert [tuple(r) for r in rows] == [("i", 1.0, 6.0, 3.0), ("v", 2.0, 4.5, 3.25)]
    rows = profile.grouped_summary(df, "g", ["v"], ["i"]).collect()
    assert [tuple(r) for r in rows] == [("a", 2, 2.0, 1, 2), ("b", 1, 4.5, 6, 6)]
    assert [r.i for r in profile.preview(df, ["i"], 2).collect()] == [1, 2]
