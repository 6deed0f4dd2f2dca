import random
from collections import Counter

import pytest

from bandscope.operators.heavy import top_values


def by_hand(values, k):
    return sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]


@pytest.mark.parametrize("shape", ["skewed", "even", "ties", "few", "none"])
@pytest.mark.parametrize("buckets", [1, 16, 1 << 16])
def test_nothing_is_missed(spark, shape, buckets):
    rng = random.Random(3)
    values = {
        "skewed": [int(rng.paretovariate(0.7)) for _ in range(3000)] + [None] * 40,
        "even": [rng.randrange(900) for _ in range(3000)],
        "ties": [k % 500 for k in range(1000)],
        "few": [1, 1, None, 2],
        "none": [],
    }[shape]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert [tuple(r) for r in top_values(df, "v", 12, buckets).collect()] == by_hand(values, 12)


def test_light_buckets_are_not_counted(spark):
    """With one heavy value nearly all buckets are below the bound."""
    df = spark.range(5000).selectExpr("IF(id < 4000, 7, id) AS v")
    got = top_values(df, "v", 1)
    assert [tuple(r) for r in got.collect()] == [(7, 4000)]
    with pytest.raises(ValueError):
        top_values(df, "v", 0)
