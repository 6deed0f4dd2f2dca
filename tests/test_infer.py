import pytest

from bandscope.session import scratch_path
from bandscope.sources import infer, layers
from bandscope.sources.csv import read_text_csv, write_csv


def types(spark, columns, null_tokens=("",)):
    """The type of each list of texts."""
    rows = list(zip(*columns.values(), strict=True))
    text = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    return {r.column_name: r.type for r in infer.profile_type(infer.type_profile(text, null_tokens)).collect()}


def test_narrowest_type_that_all_values_fit(spark):
    columns = {
        "small": ["1", "-2", None, "+3"],
        "large": ["1", "9223372036854775807", None, ""],
        "beyond": ["1", "9223372036854775808", None, ""],
        "part": ["1", "2.5", "-1e3", ".5"],
        "whole": ["1", "2.0", "3", "4"],
        "flag": ["true", "FALSE", None, "True"],
        "flag_and_number": ["true", "1", None, "0"],
        "day": ["2024-02-29", "1999-12-31", None, ""],
        "no_day": ["2023-02-29", "1999-12-31", None, ""],
        "moment": ["2024-02-29 10:11:12", "1999-12-31", "2000-01-01T00:00:00.25", None],
        "word": ["a", "1", "2", "3"],
        "padded": [" 1", "2", "3", "4"],
        "suffix": ["1d", "2", "3", "4"],
        "yes": ["yes", "no", "y", "n"],
        "dot": [".", "1", "2", "3"],
        "none": [None, None, "", None],
        "with a .dot": ["1", "2", "3", "4"],
    }
    assert types(spark, columns) == {
        "small": "int", "large": "bigint", "beyond": "double", "part": "double", "whole": "double", "flag": "boolean",
        "flag_and_number": "string", "day": "date", "no_day": "string", "moment": "timestamp_ntz", "word": "string",
        "padded": "string", "suffix": "string", "yes": "string", "dot": "string", "none": "string", "with a .dot": "int",
    }


def test_null_tokens(spark):
    columns = {"n": ["1", "NA", "2"], "m": ["1", "None", "2"]}
    assert types(spark, columns, ("", "NA")) == {"n": "int", "m": "string"}


def test_profiles_add_up(spark):
    a = spark.createDataFrame([("1", "x"), (None, "2")], "p string, q string")
    b = spark.createDataFrame([("2.5", "7")], "p string, r string")
    both = infer.merge_profiles(infer.type_profile(a), infer.type_profile(b))
    told = {r.column_name: (r.type, r.rows, r.nulls, r.n_fit) for r in infer.profile_type(both).collect()}
    assert told == {"p": ("double", 3, 1, 2), "q": ("string", 2, 0, 2), "r": ("int", 1, 0, 1)}


def test_one_scan_one_aggregation(spark):
    text = spark.createDataFrame([("1", "x")], "p string, q string")
    plan = infer.type_profile(text)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and plan.count("Join") == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "p string")
    assert [tuple(r) for r in infer.profile_type(infer.type_profile(none)).collect()] == [("p", "string", 0, 0, 0)]
    assert infer.profile_type(infer.type_profile(none.select())).collect() == []


def test_a_late_value_is_seen(spark):
    """The last of many rows decides the type; a sample would miss it."""
    path = scratch_path(spark, "late")
    write_csv(spark.range(20_000).selectExpr("CASE WHEN id = 19999 THEN 'x' ELSE CAST(id AS string) END AS v", "id"), path)
    assert infer.infer_schema(spark, path).simpleString() == "struct<v:string,id:int>"
    rows = infer.read_inferred_csv(spark, path)
    assert rows.filter("v = 'x'").first().id == 19999 and rows.count() == 20_000


def test_landing_without_a_schema(spark):
    home = scratch_path(spark, "landing")
    spark.createDataFrame([("1", "2024-01-01", "a"), ("2", None, "NA")], "k string, d string, t string").write.option("header", True).csv(f"{home}/raw")
    landed = layers.land_bronze(spark, f"{home}/raw", f"{home}/bronze", null_tokens=("", "NA"))
    assert landed.dtypes == [("k", "int"), ("d", "date"), ("t", "string")]
    assert sorted(str(tuple(r)) for r in landed.collect()) == ["(1, datetime.date(2024, 1, 1), 'a')", "(2, None, None)"]
    assert read_text_csv(spark, f"{home}/raw").count() == 2


def test_counts_are_of_all_rows(spark):
    text = spark.createDataFrame([("1",), ("1",), (None,)], "p string")
    row = infer.type_profile(text).first()
    assert (row.rows, row.nulls, row.fits_int, row.fits_bigint, row.fits_double, row.fits_boolean) == (3, 1, 2, 2, 2, 0)


@pytest.mark.parametrize("kind", list(infer.LATTICE))
def test_wider_types_take_narrower_values(spark, kind):
    chains = {"int": ["bigint", "double"], "bigint": ["double"], "date": ["timestamp_ntz"]}
    sample = {"boolean": "true", "int": "5", "bigint": "5000000000", "double": "0.5", "date": "2024-01-01", "timestamp_ntz": "2024-01-01 00:00:00"}
    row = infer.type_profile(spark.createDataFrame([(sample[kind],)], "p string")).first()
    assert [t for t in infer.LATTICE if row[f"fits_{t}"]] == [kind, *chains.get(kind, [])]
