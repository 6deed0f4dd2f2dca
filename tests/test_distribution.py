import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bandscope.operators import distribution as dist


def counts(df, column, bins=20):
    return [r.n for r in dist.histogram(df, [column], bins).collect()]


def doubles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def test_maximum_lands_in_the_last_bin(spark):
    n = counts(doubles(spark, [float(i) for i in range(11)]), "v")
    assert len(n) == 20 and sum(n) == 11 and n[19] == 1
    assert n == list(np.histogram(range(11), bins=20)[0])


def test_single_value_and_empty(spark):
    assert counts(doubles(spark, [3.0, 3.0, 3.0]), "v") == [3] + [0] * 19
    assert counts(doubles(spark, []), "v") == [0] * 20


def test_unbinnable_values_are_left_out(spark):
    values = [1.0, 2.0, None, float("nan"), float("inf"), float("-inf")]
    rows = dist.histogram(doubles(spark, values), ["v"], 2).collect()
    assert [(r.lo, r.hi, r.n) for r in rows] == [(1.0, 1.5, 1), (1.5, 2.0, 1)]


def test_several_columns_have_their_own_ranges(spark):
    df = spark.createDataFrame([(0, 100.0), (4, 200.0), (None, 300.0)], "a int, b double")
    rows = dist.histogram(df, ["a", "b"], 2).collect()
    assert [tuple(r) for r in rows] == [
        ("a", 0, 0.0, 2.0, 1),
        ("a", 1, 2.0, 4.0, 1),
        ("b", 0, 100.0, 200.0, 1),
        ("b", 1, 200.0, 300.0, 2),
    ]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(-50, 50).map(lambda i: i / 10), min_size=2, max_size=40), st.integers(1, 13)
)
def test_bins_agree_with_numpy(spark, values, bins):
    if min(values) < max(values):
        assert counts(doubles(spark, values), "v", bins) == list(np.histogram(values, bins=bins)[0])


def test_box_of_ten_values(spark):
    values = [4.1, 5, 6.3, 7, 8.8, 9, 1.2, 20, 3, 3.3]
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    r = dist.box_stats(df, "g", "v").first()
    assert (r.n, r.outliers, r.whisker_low, r.whisker_high) == (10, 1, 1.2, 9.0)
    assert (r.q1, r.median, r.q3) == pytest.approx((3.5, 5.65, 8.35))
    assert (r.fence_low, r.fence_high) == pytest.approx((-3.775, 15.625))
    assert [tuple(x) for x in dist.outliers(df, "g", "v").collect()] == [("g", 20.0)]


def test_whisker_never_ends_inside_the_box(spark):
    df = spark.createDataFrame([("g", v) for v in (1.0, 1.0, 1.0, 100.0)], "g string, v double")
    r = dist.box_stats(df, "g", "v").first()
    assert (r.q3, r.whisker_high, r.outliers) == (25.75, 25.75, 1)


def test_groups_with_null_label_null_and_nan_values(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", float("nan")), ("a", None), ("a", 5.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r.median) for r in dist.box_stats(df, "g", "v").collect()}
    assert got == {None: (2, 2.0), "a": (1, 5.0)}
    assert dist.box_stats(df.limit(0), "g", "v").collect() == []


def skewed_rows(seed, n):
    """A hot group, a hot value, ties at the quartiles and a heavy tail."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        g = "hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}"
        v = 7.0 if rng.random() < 0.35 else round(rng.lognormvariate(0, 2), rng.choice([0, 1, 6]))
        rows.append((g, v))
    return rows


def reference_box(values):
    q1, q2, q3 = (float(np.quantile(values, p)) for p in (0.25, 0.5, 0.75))
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    return (
        len(values),
        q1,
        q2,
        q3,
        min(min(v for v in values if v >= lo), q1),
        max(max(v for v in values if v <= hi), q3),
        sum(v < lo or v > hi for v in values),
    )


@pytest.mark.parametrize("large, size", [(10**6, 10**6), (1, 500), (2000, 500)])
def test_box_against_brute_force(spark, conf, large, size):
    """All ways to the quantiles: percentile, groups cut down to brackets, and some of each."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = skewed_rows(3, 12_000)
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {
        r.g: (r.n, r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.outliers)
        for r in dist.box_stats(df, "g", "v", large, size).collect()
    }
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g] == pytest.approx(reference_box(values), rel=1e-12)


def test_every_way_handles_null_labels_and_few_rows(spark):
    rows = [(None, float(v)) for v in (1, 3, 4, 90)] + [("a", 5.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    expected = {None: (4, 2.5, 3.5, 25.5), "a": (1, 5.0, 5.0, 5.0)}
    for large in (100, 2, 1):
        got = dist.box_stats(df, "g", "v", large).collect()
        assert {r.g: (r.n, r.q1, r.median, r.q3) for r in got} == expected
        assert dist.outliers(df, "g", "v", large).count() == 1


def every_way(df):
    """Statistics as bits, and outlier rows, by percentile, by ranks, and with both among the groups."""
    ways = []
    for large, size in ((10**9, 10**9), (1, 200), (12, 200)):
        stats = {tuple(repr(x) for x in r) for r in dist.box_stats(df, "g", "v", large, size).collect()}
        rows = sorted(tuple(r) for r in dist.outliers(df, "g", "v", large, size).collect())
        ways.append((stats, rows))
    return ways


def test_one_answer_by_every_way(spark):
    """Values whose fences are hit to the bit, infinite values, and many random groups."""
    hit = [2.8, 4.2, 5.6, 1.6, 6.0, 4.0, -2.3, 4.7, -1.6, 20.5, 3.8, 6.2]
    inf = float("inf")
    rows = [("hit", v) for v in hit] + [("inf", v) for v in (1.0, 2.0, inf, inf, inf)]
    rows += [("mixed", v) for v in (-inf, -inf, 0.0, inf)]
    rng = random.Random(11)
    for g in range(3000):
        rows += [(f"r{g}", round(rng.uniform(-5, 25), 1)) for _ in range(rng.randint(4, 30))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    first, *others = every_way(df)
    assert all(other == first for other in others)


def test_ranges_follow_the_counts(spark, conf):
    df = spark.range(4000).selectExpr("1 as group", "cast(id as double) as value", "true as exact")
    for partitions in ("4", "64"):
        conf(spark__sql__shuffle__partitions=partitions)
        parts = dist.sorted_counts(df, 500).groupBy("part").count().collect()
        assert 6 <= len(parts) <= 8 and max(r["count"] for r in parts) < 1200


def test_range_beyond_the_largest_double(spark):
    assert counts(doubles(spark, [-1e308, 0.0, 1e308]), "v", 4) == [1, 0, 1, 1]


def cut_down(df, probabilities, parts=8):
    values = dist.present(df, "g", "v")
    return dist.bracketed(values, dist.group_sizes(values), probabilities, parts)


def test_brackets_keep_few_values_and_every_row(spark):
    df = spark.range(200_000).selectExpr("id % 2 as g", "cast(id as double) * 1.5 as v")
    near = cut_down(df, dist.QUARTILES)
    assert near.count() == 200_000
    assert near.where("exact").count() < 2_000


def test_a_missed_bracket_is_noticed_and_made_good(spark, monkeypatch):
    """With brackets around the wrong quantiles the ranks are inexact, and the full way runs."""
    df = spark.range(30_000).selectExpr("1 as g", "cast(id as double) as v")
    wrong = dist.sorted_counts(cut_down(df, (0.1, 0.2, 0.3)))
    assert dist.quantiles(wrong, dist.QUARTILES).first().exact is False
    right = dist.bracketed
    monkeypatch.setattr(dist, "bracketed", lambda v, g, p, n: right(v, g, (0.1, 0.2, 0.3), n))
    r = dist.box_stats(df, "g", "v", 10_000).first()
    assert (r.q1, r.median, r.q3) == (7499.75, 14999.5, 22499.25)


def test_sketches_in_slices_bracket_the_quantiles(spark, monkeypatch):
    """Several slices of sorted rows: brackets are wide there, and the result the same."""
    monkeypatch.setattr(dist, "MERGED", 2)
    df = spark.range(0, 100_000, 1, 8).selectExpr("1 as g", "cast(id as double) as v")
    values = dist.present(df, "g", "v")
    r = dist.group_brackets(values, dist.QUARTILES, 8).first()
    assert r._low_0 <= 24999 and r._high_0 >= 25000 and r._low_2 <= 74999 and r._high_2 >= 75000
    box = dist.box_stats(df, "g", "v", 50_000).first()
    assert (box.q1, box.median, box.q3) == (24999.75, 49999.5, 74999.25)
