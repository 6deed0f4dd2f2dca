import pytest

from bandscope import Dimension, StarSpec
from bandscope.operators.keys import category_dim, category_dim_hash, dense_ids, key_report, resolve_fk
from bandscope.operators.star import split_star


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_category_ids_are_dense_and_stable(spark, conf, adaptive):
    conf(spark__sql__adaptive__enabled=adaptive)
    names = ["Mathematics", "CS", "Engineering", "Business"]
    df = spark.createDataFrame([(n,) for n in names * 5], "d string").repartition(4)
    rows = category_dim(df, "d", "name", "id").collect()
    assert sorted((r.id, r.name) for r in rows) == [
        (1, "Business"),
        (2, "CS"),
        (3, "Engineering"),
        (4, "Mathematics"),
    ]


def test_ids_over_many_range_partitions(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="16")
    df = spark.range(20_000).selectExpr("cast((id * 7919) % 10007 as string) as k")
    rows = category_dim(df, "k", "k", "id").collect()
    expected = {k: i for i, k in enumerate(sorted({r.k for r in rows}), start=1)}
    assert len(rows) == 10007 and {r.k: r.id for r in rows} == expected


def test_null_is_no_category(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), (None,)], "d string")
    rows = category_dim(df, "d", "name", "id").collect()
    assert {r.name: r.id for r in rows} == {"a": 1, "b": 2}
    assert category_dim_hash(df, "d", "name", "id").where("name IS NULL").count() == 0
    assert category_dim(df.limit(0), "d", "name", "id").count() == 0
    facts = resolve_fk(df, category_dim(df, "d", "name", "id"), "d", "name", "id").collect()
    assert sorted((r.d or "", r.id) for r in facts if r.d) == [("a", 1), ("b", 2)]
    assert [r.id for r in facts if r.d is None] == [None, None]


def test_range_count_follows_the_keys(spark, conf):
    df = spark.range(3000).selectExpr("cast(id as string) as k")
    for partitions in ("4", "64"):
        conf(spark__sql__shuffle__partitions=partitions)
        numbered = dense_ids(df, "k", "id", size=500)
        assert numbered.select("id").distinct().count() == 3000
        assert "rangepartitioning" not in numbered._jdf.queryExecution().executedPlan().toString()
    keys = sorted(str(i) for i in range(3000))
    assert {r.k: r.id for r in dense_ids(df, "k", "id", size=500).collect()} == {k: i for i, k in enumerate(keys, 1)}


def test_foreign_key_resolution(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "?"), (3, None)], "k int, d string")
    dim = category_dim(fact.where("d = 'a'"), "d", "name", "id")
    rows = resolve_fk(fact, dim, "d", "name", "id").collect()
    assert sorted((r.k, r.id) for r in rows) == [(1, 1), (2, None), (3, None)]


def test_key_report(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("b",), ("x",), (None,)], "id string")
    dim = spark.createDataFrame(
        [("a",), ("b",), ("b",), ("b",), ("c",), ("c",), (None,), (None,)], "id string"
    )
    empty = dim.limit(0)
    rows = key_report(
        fact, [Dimension("d", dim, "id", "id", []), Dimension("e", empty, "id", "id", [])]
    ).collect()
    assert [tuple(r) for r in rows] == [("d", 2, 3, 2, 2), ("e", 0, 0, 0, 5)]


SPEC = StarSpec(
    key="id",
    key_alias="entity_id",
    entity={"name": "name"},
    behaviour={"sleep": "sleep"},
    category="segment",
    category_alias="segment",
    category_id="segment_id",
    fact={"grade": "mark"},
)


def test_split_star(spark):
    bronze = spark.createDataFrame(
        [(7, "n1", 6.5, "CS", "A", "dropped"), (8, "n2", None, "Arts", "F", "dropped")],
        "id int, name string, sleep double, segment string, grade string, other string",
    )
    star = split_star(bronze, SPEC)
    assert star["entity"].columns == ["entity_id", "name"]
    assert star["behaviour"].columns == ["entity_id", "sleep"]
    assert dict(star["fact"].dtypes) == {
        "entity_id": "string",
        "segment": "string",
        "mark": "string",
        "segment_id": "string",
    }
    got = sorted(tuple(r) for r in star["fact"].select("entity_id", "segment_id", "mark").collect())
    assert got == [("7", "2", "A"), ("8", "1", "F")]
    with pytest.raises(ValueError, match="missing columns"):
        split_star(bronze.drop("sleep"), SPEC)
