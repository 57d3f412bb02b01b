"""Hard negatives against brute force; trees, bounds and what they save; odd inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recheck.llm import hard_negatives as H

KIND = "vec_id bigint, embedding array<float>, label int, score string, q string, anchor string"


def clustered(n, seed=1, dims=8, centres=6, spread=0.05, labels=3):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dims))
    own = rng.integers(0, centres, n)
    x = (c[own] + spread * rng.normal(size=(n, dims))).astype(np.float32)
    return [(i, [float(v) for v in x[i]], int(rng.integers(0, labels)), "a", "b", "c") for i in range(n)]


def plain(rows, every=10, positives=5, negatives=3):
    """All scores of all pairs."""
    rows = {(i, lab, tuple(math.floor(256 * v) for v in x)) for i, x, lab, *_ in rows
            if i is not None and lab is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)}
    out = set()
    for i, lab, x in rows:
        if i % every:
            continue
        score = [(-sum(a * b for a, b in zip(x, y)), j, other) for j, other, y in rows if len(y) == len(x)]
        for s, j, _ in sorted(r for r in score if r[2] == lab and r[1] != i)[:positives]:
            near = sorted(r for r in score if r[2] != lab and 50 * -s <= 100 * -r[0] <= 95 * -s)[:negatives]
            out |= {(i, j, k + 1, m, -s, -t) for k, (t, m, _) in enumerate(near)}
    return out


def mined(spark, rows, every=10, **more):
    return {tuple(r) for r in H.mine(spark.createDataFrame(rows, KIND), F.col("vec_id") % every == 0, **more).collect()}


@pytest.mark.parametrize("size, wave", [(256, 1 << 25), (7, 1 << 25), (4, 600)])
def test_equals_brute_force(spark, monkeypatch, size, wave):
    monkeypatch.setattr(H, "ANCHORS", size)
    rows = clustered(300) + clustered(60, seed=2, spread=2.0)[:0]
    got = mined(spark, rows, wave_bytes=wave)
    assert got == plain(rows) and len(got) > 150


def test_random_vectors_and_ties(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)], rnd.randint(0, 2), "", "", "") for i in range(400)]
    assert mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = clustered(80) + [
        (100, None, 1, "", "", ""), (110, [1.0] * 8, None, "", "", ""), (None, [1.0] * 8, 1, "", "", ""),
        (120, [1.0] * 7 + [nan], 1, "", "", ""), (130, [inf] * 8, 1, "", "", ""), (140, [None] + [1.0] * 7, 1, "", "", ""),
        (150, [1.0, 2.0], 1, "", "", ""), (151, [1.0, 1.5], 1, "", "", ""), (152, [1.0, 1.2], 0, "", "", ""),
        (160, [], 0, "", "", ""), (161, [], 0, "", "", ""), (162, [], 1, "", "", ""),
        (170, [0.0] * 8, 2, "", "", ""), (10, [0.5] * 8, 1, "", "", ""), (-20, [0.4] * 8, 0, "", "", "")]
    rows += [r for r in rows[:30] for _ in range(3)]  # repeated rows count once
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, positives=2, negatives=1) == plain(rows, positives=2, negatives=1)
    assert mined(spark, []) == set() and mined(spark, rows[:0]) == set()
    assert mined(spark, [(1, [1.0], 1, "", "", "")]) == set() and mined(spark, [(10, [1.0], 1, "", "", "")]) == set()


def test_large_components_are_exact(spark):
    rnd = random.Random(2)
    rows = [(i, [float(np.float32(rnd.choice([1, 1, -1]) * rnd.uniform(0.5, 1) * 2 ** rnd.randint(10, 20)))
                 for _ in range(3)], i % 3, "", "", "") for i in range(90)]
    assert mined(spark, rows) == plain(rows)
    assert H.products(np.array([[1e30, 1.0]]), np.array([1e30, 1.0])).tolist() == [2 ** 63 - 1]


def test_one_vector_many_times(spark):
    rows = [(i, [0.5, 0.25], 1, "", "", "") for i in range(600)] + [(1000 + i, [0.4, 0.2], 0, "", "", "") for i in range(600)]
    assert mined(spark, rows, every=100) == plain(rows, every=100)


def test_tree_is_minimal():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(9, 3))
    order, parent, edge = H.spanning_tree(x)
    assert sorted(order) == list(range(9)) and parent[order[0]] == -1
    seen = {order[0]}
    for i in order[1:]:
        assert parent[i] in seen and edge[i] == pytest.approx(np.linalg.norm(x[i] - x[parent[i]]))
        seen.add(i)
    group, total = list(range(9)), 0.0  # Kruskal
    for d, i, j in sorted((np.linalg.norm(x[i] - x[j]), i, j) for i in range(9) for j in range(i)):
        if group[i] != group[j]:
            total += d
            group = [group[i] if g == group[j] else g for g in group]
    assert edge.sum() == pytest.approx(total)


def test_bounds_save_scores():
    """Anchors close to each other: most candidates are never scored with most anchors, and nothing is missed."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 256
    x = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)) * 4)
    ids, label, tie = np.arange(4000), rng.integers(0, 2, 4000), np.zeros(4000, np.int64)
    a = np.flatnonzero(((x - x[0]) ** 2).sum(1) < 40 ** 2)[:60]
    order, parent, edge = H.spanning_tree(x[a])
    block = H.Block(np.arange(len(a)), ids[a], label[a], x[a], order, parent, edge, [])
    best = [[H.Best(5, -np.inf, np.inf)] for _ in a]
    scored = H.searched(block, best, x, ids, label, tie, same=True)
    assert scored < 0.3 * len(a) * len(x)
    for k, i in enumerate(a):
        s = x @ x[i]
        want = sorted((-s[j], j) for j in range(4000) if label[j] == label[i] and j != i)[:5]
        assert [(r[0], r[1]) for r in best[k][0].rows] == want
