"""Neighbours against brute force; ties, odd vectors, recall by factor."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossaflow.llm import vptree


def exact(x, y):
    total = 0.0
    for a, b in zip(x, y, strict=True):
        total += float(a) * float(b)
    return total


def brute(rows, k, every=20):
    out = []
    for q, x in rows:
        if q % every == 0:
            scored = sorted((-exact(x, y), i) for i, y in rows if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def search(spark, rows, kind="float", every=20, **settings):
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], f"vec_id long, embedding array<{kind}>")
    got = vptree.neighbours(frame, F.col("vec_id") % every == 0, **settings).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_exact_search(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(vptree, "LEAF", 16)
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.normal(size=(300, 6)), np.tile(rng.normal(size=6), (300, 1)), rng.integers(-1, 2, (200, 6))]).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(data) if np.any(v)]
    assert search(spark, rows, k=7, shard_rows=shard_rows, block_rows=11) == brute(rows, 7)


def test_ties_go_to_smaller_ids(spark):
    rows = [(0, (1.0, 0.0))] + [(i, (1.0, y)) for i, y in zip(range(1, 201), np.random.default_rng(4).permutation(200) / 7 + 1, strict=True)]
    assert search(spark, rows, "double", every=1000, shard_rows=50) == [(0, r, r, 1.0) for r in range(1, 21)]
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate(rng.integers(-1, 2, (1000, 6))) if np.any(v)]
    assert search(spark, rows, every=3, shard_rows=300) == brute(rows, 20, 3)


def test_one_large_norm_changes_nothing_for_others(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(600, 8)))] + [(999, np.full(8, 1e8))]
    assert search(spark, rows, "double", shard_rows=200, k=5) == brute(rows, 5)


def clustered(n=40, per=100, dim=16):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(n, dim)) * 4
    return [(i, v) for i, v in enumerate(np.repeat(centres, per, 0) + rng.normal(size=(n * per, dim)))]


@pytest.mark.parametrize(("factor", "least"), [(1.0, 1.0), (0.8, 0.95), (0.6, 0.9)])
def test_smaller_factors_prune_and_still_find(spark, monkeypatch, factor, least):
    monkeypatch.setattr(vptree, "LEAF", 32)
    rows = clustered()
    want = {(q, i) for q, _, i, _ in brute(rows, 10, 40)}
    got = {(q, i) for q, _, i, _ in search(spark, rows, "double", every=40, k=10, factor=factor, shard_rows=500)}
    assert len(want & got) / len(want) >= least


def test_bounds_leave_shards_and_branches_out(spark, monkeypatch):
    monkeypatch.setattr(vptree, "LEAF", 32)
    ids, x = np.arange(4000), np.array([v for _, v in clustered()])
    compared = []
    old = vptree.Tree._compare
    monkeypatch.setattr(vptree.Tree, "_compare", lambda self, leaf, at: (compared.append(len(at) * self.leaves[leaf][1]), old(self, leaf, at)))
    tree, shares = vptree.Tree.build(ids, x), []
    for factor in (1.0, 0.6):
        compared.clear()
        tree.search(ids[:200], x[:200], 10, factor)
        shares.append(sum(compared) / (200 * 4000))
    assert shares[1] < shares[0] < 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, None, 1), (3, [], 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0], 1), (8, [2.0, 0.0], 1), (8, [2.0, 0.0], 1), (8, [1.5, 0.0], 1), (None, [1.0, 1.0], 1), (9, [inf, 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = vptree.neighbours(frame, F.col("vec_id") % 20 == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 2.0), (0, 2, 8, 2.0)]
    assert vptree.neighbours(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert vptree.neighbours(frame.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
    # Of a query's own vectors the smallest counts.
    twice = spark.createDataFrame([(0, [2.0, 1.0]), (0, [1.0, 1.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in vptree.neighbours(twice, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1.0)]


def test_pivots_are_drawn_without_sorting_the_table(spark, monkeypatch):
    """More pivots than a limit by rank would be pushed down for: few rows
    reach the driver, and the search stays exact."""
    rng = np.random.default_rng(8)
    frame = spark.createDataFrame([(i % 2500, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(3000, 3)))], "id long, v array<double>").withColumn("dim", F.size("v"))
    found = vptree.pivots_of(frame, {3: 3000}, 1024)
    assert 900 < len(found[3]) <= 1024
    assert 5 <= len(vptree.pivots_of(frame, {3: 3000}, 20)[3]) <= 20
    data = [(i, v) for i, v in enumerate(rng.normal(size=(400, 4)))]
    assert search(spark, data, "double", shard_rows=10, k=3) == brute(data, 3)
    same = spark.createDataFrame([(7, [float(i), 1.0]) for i in range(500)], "id long, v array<double>").withColumn("dim", F.size("v"))
    assert vptree.pivots_of(same, {2: 500}, 1)[2].tolist() == [[0.0, 1.0]]
