import math

import numpy as np
from helpers import joined

from bandscope.llm import embed

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v and all(x is not None and math.isfinite(x) for x in v) and any(v)


def expected(rows, threshold=0.98):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    pairs = []
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows[:i]):
            if usable(a) and usable(b) and la is not None and la == lb and len(a) == len(b):
                if np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                    pairs.append((i, j))
    links = [0] * len(rows)
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    root = joined(pairs, len(rows))
    smallest = {}
    for (name, _, _), r in zip(rows, root):
        smallest[r] = min((d for d in (smallest.get(r), name) if d is not None), default=None)
    return sorted(((name, n, smallest[r], name == smallest[r]) for (name, _, _), r, n in zip(rows, root, links)), key=str)


def found(df):
    return sorted((tuple(r) for r in embed.near_embeddings(df).collect()), key=str)


def clusters(seed, size, groups, each):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(size)
        for _ in range(each):
            noise = rng.standard_normal(size) * rng.choice([0.02, 0.08, 0.15])
            rows.append((len(rows), [float(x) for x in centre + noise], g % 3))
    return rows


def test_links_agree_with_all_pairs(spark):
    rows = clusters(1, 48, 30, 9)
    got, want = found(spark.createDataFrame(rows, SCHEMA)), expected(rows)
    same = sum(a == b for a, b in zip(got, want))
    assert sum(n for _, n, _, _ in want) > 100 and same >= 0.99 * len(want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_a_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(embed, "GROUP_BLOCK", 16)
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(32)
    rows = [(i, [float(x) for x in centre + rng.standard_normal(32) * 0.03], 1) for i in range(120)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_odd_vectors(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, one, 1), (2, one, 1), (2, one, 1), (3, [2.0, 4.0, 6.0, 8.0], 1), (4, one, 2), (5, one, None), (6, None, 1), (7, [0.0] * 4, 1),
        (8, [1.0, None, 3.0, 4.0], 1), (9, [1.0, float("nan"), 3.0, 4.0], 1), (10, [1.0, float("inf"), 3.0, 4.0], 1), (None, one, 1),
        (11, [], 1), (12, [1.0, 2.0, 3.0], 1), (13, [5.0], 1), (14, [7.0], 1), (15, [-7.0], 1),
    ]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert [g[:3] for g in got] == [e[:3] for e in expected(rows)]
    assert {g[0]: g[3] for g in got}[None] is False
    wide = spark.createDataFrame([(i, v, l, 9, "x") for i, v, l in rows], SCHEMA + ", cls int, vector string")
    assert found(wide) == got
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(2)
    size, n = 64, 400
    x = embed.unit(rng.standard_normal((n, size)))
    y = embed.unit(x + 0.3 * rng.standard_normal((n, size)))
    turned = [x @ embed.rotation(size, r).T for r in range(embed.ROTATIONS)]
    factors = np.stack([np.abs(t).sum(1) / math.sqrt(size) for t in turned], 1)
    signs = [np.where(t > 0, 1.0, -1.0) / math.sqrt(size) for t in turned]
    estimate = sum((s * (y @ embed.rotation(size, r).T)).sum(1) / factors[:, r] for r, s in enumerate(signs)) / embed.ROTATIONS
    error = estimate - (x * y).sum(1)
    spread = np.sqrt((1 / factors**2 - 1).sum(1)) / (embed.ROTATIONS * math.sqrt(size - 1))
    assert abs(error.mean()) < 0.01 and (np.abs(error) < 5 * spread).all()
    assert np.allclose(embed.rotation(size, 0) @ embed.rotation(size, 0).T, np.eye(size))


def test_more_rows_take_more_bits_and_keys():
    few, many = embed.bucket_plan(1000, 0.98, 0.999), embed.bucket_plan(10**9, 0.98, 0.999)
    assert few[0] < many[0] and few[1] < many[1]
