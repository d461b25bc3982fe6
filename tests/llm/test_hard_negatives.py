"""Hard negatives against all products."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.llm import hard_negatives
from pricewright.llm.hard_negatives import Tree

SCHEMA = "vec_id bigint, embedding array<double>, label int, ask int, shard string, score string"


def plain(rows, anchors=lambda i: i % 10 == 0, k=5, percent=80):
    good = {
        (i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = set()
    for i, label, v in good:
        if not anchors(i):
            continue
        scored = {(-sum(a * b for a, b in zip(v, w)), j, m == label) for j, m, w in good if len(w) == len(v) and j != i}
        for s, j, same in sorted(x for x in scored if x[2])[:k]:
            found = [x for x in sorted(x for x in scored if not x[2]) if percent * -s <= 100 * -x[0] <= 100 * -s]
            out |= {(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(found[:k])}
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "s", "t") for r in rows], SCHEMA)
    out = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **more)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.select(*names).collect())


def some(count, seed, spread=0.2, dims=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    return [
        (n, [x + rng.gauss(0, spread) for x in rng.choice(centres)], rng.randrange(3)) for n in range(count)
    ]


@pytest.mark.parametrize(("shard", "leaf"), [(40, 4), (10_000, 4), (10_000, 48)])
def test_equal_to_all_products(spark, monkeypatch, shard, leaf):
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", shard)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 7)
    # Workers read the module anew, so the leaf size of this process is checked on the tree itself below.
    rows = some(300, 1)
    assert mined(spark, rows) == plain(rows)


def test_edge_cases(spark):
    rows = some(60, 2, spread=0.0) + [(500 + n, [1.0] * 6, n % 2) for n in range(50)]
    rows += rows[:40]
    rows += [(10, [0.5] * 6, 1), (20, [0.0] * 6, 0), (None, [1.0] * 6, 1), (30, None, 1), (7, [1.0] * 6, None)]
    rows += [(40, [float("nan")] + [1.0] * 5, 1), (50, [float("inf")] + [1.0] * 5, 2), (60, [None] + [1.0] * 5, 1)]
    rows += [(70, [1.0, 2.0], 1), (71, [1.0, 2.0], 1), (72, [1.0, 1.9], 2), (80, [], 1), (81, [], 1), (82, [], 0)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], 0)]) == []


def test_scores_beyond_the_longs(spark):
    rows = [(10, [1e300, 1.0], 0), (11, [1e300, 2.0], 0), (12, [9e299, 1.0], 1), (13, [-1e300, 0.0], 1)]
    most = (1 << 63) - 1024
    assert mined(spark, rows) == [(10, 11, 1, 12, most, most)]


@pytest.mark.parametrize(("spread", "dims", "most"), [(0.02, 8, 0.35), (1.0, 3, 0.6)])
def test_search_skips_and_is_exact(monkeypatch, spread, dims, most):
    monkeypatch.setattr(hard_negatives, "LEAF", 8)
    points = np.unique(np.floor(256 * np.array([v for _, v, _ in some(2000, 3, spread, dims)])), axis=0)
    order, nodes, radius = Tree.grown(points)
    assert sorted(order) == list(range(len(points)))
    tree = Tree(points[order], nodes, radius)
    ids, fits = [[i] for i in range(len(points))], np.ones(len(points), bool)
    for node in range(len(nodes)):
        low, high = tree.bounds(points[0], float(np.linalg.norm(points[0])), slice(node, node + 1))
        inside = tree.points[tree.low[node] : tree.high[node]] @ points[0]
        assert low[0] <= inside.min() and inside.max() <= high[0]
    share = []
    for n in range(0, len(points), 50):
        score = tree.points @ tree.points[n]
        high = float(np.sort(score)[-20])
        for window in ((-np.inf, np.inf), (0.9 * high, high)):
            found, verified = tree.search(tree.points[n], fits, np.arange(len(points)), ids, n, [window], 5)
            inside = [(-float(s), i) for i, s in enumerate(score) if i != n and window[0] <= s <= window[1]]
            assert found[0] == sorted(inside)[:5]
            share.append(verified / len(points))
    assert np.mean(share) < most
