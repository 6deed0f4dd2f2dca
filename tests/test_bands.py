import pytest
from pyspark.sql import functions as F

from bandscope import BandSpec, Dimension, Factor, mean, rate
from bandscope.functions.bands import band, band_rank, value_rank
from bandscope.operators.cohort import cohort_mean, cohort_rate, factor_gap, factor_scorecard
from bandscope.operators.mart import build_mart, entity_measure_pairs

GRADES = BandSpec({"High": ("A", "B"), "Medium": (), "Low": ("F",)}, default="Medium")


def test_bands_and_default(spark):
    grades = ["A", "B", "C", "D", "F", None, "X"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(grades)], "id int, grade string")
    got = [r.band for r in df.select("id", band("grade", GRADES).alias("band")).orderBy("id").collect()]
    assert got == ["High", "High", "Medium", "Medium", "Low", "Medium", "Medium"]


def test_spec_is_checked():
    with pytest.raises(ValueError, match="default band"):
        BandSpec({"High": ("A",)}, default="Medium")
    with pytest.raises(ValueError, match="more than one band"):
        BandSpec({"High": ("A",), "Low": ("A",)}, default="Low")
    with pytest.raises(ValueError, match="kind"):
        Factor("x", "median", "y")


def test_rank_puts_unknown_and_null_last(spark):
    df = spark.createDataFrame([("Low",), ("?",), (None,), ("High",), ("Medium",)], "b string")
    ranks = {r.b: r.rank for r in df.select("b", band_rank("b", GRADES).alias("rank")).collect()}
    assert ranks == {"High": 1, "Medium": 2, "Low": 3, "?": 4, None: 4}
    assert df.select(value_rank("b", []).alias("r")).distinct().count() == 1


def test_null_predicate_stays_in_the_denominator(spark):
    df = spark.createDataFrame(
        [("High", 7), ("High", 9), ("High", 3), ("High", None), ("Low", 7)], "band string, stress int"
    )
    rows = cohort_rate(df, "stress", "stress >= 7", GRADES).collect()
    assert [tuple(r) for r in rows] == [("High", 4, 2, 50.0), ("Low", 1, 1, 100.0)]


def test_reports_on_no_rows(spark):
    df = spark.createDataFrame([], "band string, v double")
    card = factor_scorecard(df, [mean("v", "v"), rate("p", "v > 1")], GRADES)
    assert card.collect() == []
    assert factor_gap(card, "Low", "High").collect() == []


def test_mean_skips_null_and_orders_by_rank(spark):
    df = spark.createDataFrame(
        [("Low", 1.0), ("Low", None), ("High", 2.0), ("Medium", None)], "band string, v double"
    )
    rows = cohort_mean(df, "v", "v", GRADES).collect()
    assert [tuple(r) for r in rows] == [("High", 1, 2.0), ("Medium", 1, None), ("Low", 2, 1.0)]


def test_gap_is_null_when_a_band_is_absent(spark):
    df = spark.createDataFrame([("Low", 1.0)], "band string, v double")
    gap = factor_gap(factor_scorecard(df, [mean("v", "v")], GRADES), "Low", "High").collect()
    assert [(r.low_value, r.high_value, r.gap) for r in gap] == [(1.0, None, None)]


@pytest.fixture
def fact(spark):
    return spark.createDataFrame(
        [("a", "A", "1.5"), ("b", "F", "bad"), ("zz", "C", "2"), (None, None, "3")],
        "id string, grade string, score string",
    )


def test_mart_keeps_every_fact_row(spark, fact):
    dim = spark.createDataFrame(
        [("a", "x", "secret"), ("b", "y", "secret"), (None, "n", "secret")],
        "id string, colour string, email string",
    )
    mart = build_mart(
        fact, [Dimension("d", dim, "id", "id", ["colour"])], GRADES, "grade", {"score": "double"}
    )
    assert mart.columns == ["id", "grade", "score", "colour", "band"]
    got = sorted((tuple(r) for r in mart.collect()), key=str)
    assert got == sorted(
        [
            ("a", "A", 1.5, "x", "High"),
            ("b", "F", None, "y", "Low"),
            ("zz", "C", 2.0, None, "Medium"),
            (None, None, 3.0, None, "Medium"),
        ],
        key=str,
    )


def test_mart_refuses_repeated_keys_unless_allowed(spark, fact):
    dim = spark.createDataFrame([("a", "x"), ("a", "y")], "id string, colour string")
    dims = [Dimension("colours", dim, "id", "id", ["colour"])]
    with pytest.raises(Exception, match="dimension colours: key id is not unique"):
        build_mart(fact, dims, GRADES, "grade").collect()
    assert build_mart(fact, dims, GRADES, "grade", allow_fan_out=True).count() == 5


def test_null_keys_in_a_dimension_are_not_repeats(spark, fact):
    dim = spark.createDataFrame([(None, "x"), (None, "y"), ("a", "z")], "id string, colour string")
    mart = build_mart(fact, [Dimension("d", dim, "id", "id", ["colour"])], GRADES, "grade")
    assert mart.count() == 4


def test_missing_columns_fail_before_any_job(spark, fact):
    dim = spark.createDataFrame([("a", "x")], "id string, colour string")
    with pytest.raises(ValueError, match="missing columns"):
        build_mart(fact, [Dimension("d", dim, "id", "id", ["size"])], GRADES, "grade")
    with pytest.raises(ValueError, match="missing columns"):
        build_mart(fact, [], GRADES, "mark")


def test_pairs_need_a_match_and_both_values(spark, fact):
    entity = spark.createDataFrame(
        [("a", 20), ("b", None), (None, 30), ("c", 40)], "id string, age int"
    )
    scored = fact.withColumn("score", F.col("score").try_cast("double"))
    rows = entity_measure_pairs(entity, scored, "id", "age", "score").collect()
    assert [tuple(r) for r in rows] == [(20, 1.5)]
