"""Hard negatives against brute force; bounds, ties, odd vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossaflow.llm import mining

LIMIT = (1 << 63) - 1


def brute(rows, every, positives=5, negatives=5):
    """By exact whole numbers, over all pairs."""
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = min(kept.get(i, (label, v)), (label, v))
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in kept.items()}
    score = lambda a, b: max(-LIMIT, min(LIMIT, sum(x * y for x, y in zip(a, b, strict=True))))
    out = []
    for a, (label, x) in q.items():
        if a % every:
            continue
        scored = [(-score(x, y), i, other == label) for i, (other, y) in q.items() if i != a and len(x) == len(y)]
        for p, i, _ in sorted(s for s in scored if s[2])[:positives]:
            near = sorted((s, j) for s, j, same in scored if not same and 80 * -p <= 100 * -s <= 100 * -p)[:negatives]
            out += [(a, i, r + 1, j, -p, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


def mine(spark, rows, every, kind="float", **settings):
    frame = spark.createDataFrame([(i, lab, v, "x", 1) for i, lab, v in rows], f"vec_id long, label int, embedding array<{kind}>, id string, dim int")
    got = mining.hard_negatives(frame, F.col("vec_id") % every == 0, F.col("label"), **settings)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def listed(i, label, v):
    return (int(i), int(label), [float(x) for x in v])


@pytest.mark.parametrize("settings", [{}, {"shard_values": 1500, "few_rows": 40, "block_anchors": 7}])
def test_equal_to_brute_force(spark, monkeypatch, settings):
    monkeypatch.setattr(mining, "BLOCK", 64)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 19))
    data = (centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 19)) * 0.5).astype(np.float32)
    rows = [listed(i, rng.integers(0, 4), v) for i, v in enumerate(data)]
    assert mine(spark, rows, 10, **settings) == brute(rows, 10) != []


def test_ties_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = [listed(i, i % 3, v) for i, v in zip(rng.permutation(400), rng.integers(0, 2, (400, 5)) / 4, strict=True)]
    rows += [listed(i + 1000, 1, (0.25,) * 5) for i in range(200)]
    assert mine(spark, rows, 20, shard_values=300) == brute(rows, 20)
    again = rows + [(i, lab + 1, v[::-1]) for i, lab, v in rows[:50]]
    assert mine(spark, again, 20) == brute(again, 20)


def test_odd_rows(spark):
    fine = [listed(i, i % 2, v) for i, v in enumerate(np.random.default_rng(3).random((40, 4)).astype(np.float32))]
    nan, inf = float("nan"), float("inf")
    odd = [
        (100, None, [1.0] * 4), (110, 0, None), (120, 1, [1.0, None, 1.0, 1.0]), (130, 1, [nan] * 4), (140, 0, [inf] * 4), (None, 1, [1.0] * 4),
        (150, 0, []), (151, 1, []), (152, 0, []), (160, 5, [1.0] * 4), (170, 0, [1.0] * 3), (171, 0, [1.0] * 3), (172, 1, [0.9] * 3), (180, 0, [-1.0] * 4), (190, 0, [1e30, 1e-30, 0.0, 1.0]), (191, 1, [1e30, 0.0, -1e30, 1.0]), (200, 0, [0.0] * 4), (-10, 1, [0.5] * 4),
    ]
    got = mine(spark, fine + odd, 10)
    assert got == brute(fine + odd, 10)
    assert {g[0] for g in got} >= {150, 190, -10}
    assert mine(spark, [], 10) == []
    assert mine(spark, [(0, 1, [1.0])], 10) == []
    assert mine(spark, [(0, 1, [1e300]), (10, 1, [1e300]), (1, 2, [1e300])], 10, "double") == [(0, 10, 1, 1, LIMIT, LIMIT), (10, 0, 1, 1, LIMIT, LIMIT)]


def test_bounds_hold_and_levels_leave_less():
    rng = np.random.default_rng(4)
    base = np.repeat(rng.normal(size=(30, 8)) * 300, 8, axis=1)
    a, b = np.floor(base[:10] + rng.normal(size=(10, 64)) * 20), np.floor(base[rng.integers(0, 30, 500)] + rng.normal(size=(500, 64)) * 20)
    exact = mining.products(a, b)
    widths = []
    for (sizes, ma, da), (_, mb, db) in zip(mining.summaries(a), mining.summaries(b), strict=True):
        middle, reach = (ma * sizes) @ mb.T, da @ db.T
        assert (np.abs(exact - middle) <= reach + 1e-6).all()
        widths.append(reach.mean())
    assert widths[0] > widths[1] > widths[2]
    need = np.sort(exact, axis=1)[:, -5].astype(float)
    i, j, score = mining.left_over(a, mining.summaries(a), b, mining.summaries(b), need, np.full(10, 1e18))
    assert {*zip(i, j, strict=True)} >= {*zip(*np.nonzero(exact >= need[:, None]), strict=True)}
    assert (score == exact[i, j]).all() and len(i) < exact.size / 5


def test_exact_beyond_double_precision():
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**21, 1.0], [2.0**30, -1.0]])
    assert mining.products(a, b).tolist() == [[2**61 + 1, LIMIT]]
