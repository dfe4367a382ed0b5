import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, vector array<bigint>"


def brute(rows, anchors, low=80, high=100, count=5):
    clean = {}
    for i, l, v in rows:
        if i is not None and l is not None and v is not None and None not in v:
            clean[i] = min(clean.get(i, (l, v)), (l, v))
    size = max((len(v) for _, v in clean.values()), default=0)
    full = {i: v + [0] * (size - len(v)) for i, (_, v) in clean.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(full[a], full[b]))
    out = []
    for a in sorted(clean):
        if not anchors(a):
            continue
        own = [(-dot(a, b), b) for b in clean if b != a and clean[b][0] == clean[a][0]]
        for s, p in sorted(own)[:count]:
            s = -s
            rest = [(-dot(a, b), b) for b in clean if clean[b][0] != clean[a][0]]
            rest = [x for x in sorted(rest) if low * s <= -100 * x[0] <= high * s]
            out += [(a, p, r, b, s, -t) for r, (t, b) in enumerate(rest[:count], 1)]
    return sorted(out)


def mined(spark, rows, modulus=10, **how):
    table = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit("x")).withColumn("n", F.lit(1))
    return sorted(map(tuple, H.mine(table, F.col("vec_id") % modulus == 0, **how).collect()))


@pytest.mark.parametrize("scale,dims,labels", [(256, 8, 3), (4, 3, 2), (1, 2, 4)])
def test_equals_brute_force(spark, scale, dims, labels, monkeypatch):
    monkeypatch.setattr(H, "SMALLEST", 64)
    monkeypatch.setattr(H, "PART", 40)
    monkeypatch.setattr(H, "GROUP", 10)
    rng = np.random.default_rng(dims)
    centre = rng.normal(size=(labels, dims))
    rows = []
    for i in range(400):
        label = int(rng.integers(0, labels))
        rows.append((i, label, np.floor(scale * (centre[label] + rng.normal(size=dims))).astype(int).tolist()))
    want = brute(rows, lambda a: a % 10 == 0)
    assert want and mined(spark, rows) == want


def test_many_copies_of_one_vector_and_one_label_of_most_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "SMALLEST", 64)
    rng = np.random.default_rng(1)
    rows = [(i, 0 if i % 3 else 1, [3, 4, 0] if i % 2 else rng.integers(-5, 6, 3).tolist()) for i in range(500)]
    assert mined(spark, rows, 50) == brute(rows, lambda a: a % 50 == 0)


def test_tree_bounds_hold_and_save_scores():
    """Near anchors, far rows: fewer scores are computed than there are, and none is missed."""
    rng = np.random.default_rng(4)
    anchors = (1000 * rng.normal(size=6)[None, :] + rng.normal(size=(60, 6))).astype(np.int64)
    rows = (300 * rng.normal(size=(3000, 6))).astype(np.int64)
    order, parent, edge = H.spanning_tree(anchors)
    assert sorted(order.tolist()) == list(range(60)) and parent[0] == -1 and (parent[1:] < np.arange(1, 60)).all()
    for k in range(1, 60):
        d = np.linalg.norm((anchors[order[k]] - anchors[order[parent[k]]]).astype(float))
        assert np.isclose(edge[k], d)
        later = np.linalg.norm((anchors[order[k]] - anchors[order[:k]]).astype(float), axis=1)
        assert np.isclose(later.min(), d)
    scorer, found = H.Scorer(rows, anchors[order]), {}
    floor = np.sort(rows @ anchors.mean(axis=0))[-20]
    computed = H._walk(scorer, np.arange(60), parent, edge, slice(0, 3000), lambda k, lo, hi: hi >= floor,
                       lambda k, at, score: found.update({(k, int(i)): int(s) for i, s in zip(at, score)}))
    assert computed < 0.3 * 60 * 3000
    exact = rows @ anchors[order].T
    assert {(k, i) for i, k in zip(*np.nonzero(exact >= floor))} <= set(found)
    assert all(exact[i, k] == s for (k, i), s in found.items())


def test_large_components_are_scored_in_whole_numbers(spark):
    big = 2**30
    rows = [(0, 0, [big, 1]), (1, 0, [big, 2]), (2, 1, [big, 3]), (3, 1, [big, 1]), (4, 1, [big, 2]), (5, 1, [big - 1, 0])]
    assert mined(spark, rows) == brute(rows, lambda a: a % 10 == 0)


def test_edge_rows(spark):
    rows = [(0, 0, [1, 2]), (0, 0, [1, 2]), (None, 0, [1, 2]), (10, None, [1, 2]), (20, 0, None), (30, 0, [1, None]),
            (40, 0, []), (50, 5, [1, 1]), (1, 0, [2, 2]), (2, 1, [1, 2]), (3, 1, [2]), (4, 1, [2, 1]), (4, 0, [9, 9, 0])]
    assert mined(spark, rows) == brute(rows, lambda a: a % 10 == 0)
    assert mined(spark, rows, positives=1, negatives=1) == brute(rows, lambda a: a % 10 == 0, count=1)
    assert mined(spark, rows[:0]) == [] and mined(spark, rows[2:6]) == []
    assert mined(spark, [(1, 0, [1]), (2, 1, [1])]) == []          # no anchors
    assert mined(spark, [(0, 0, [1]), (2, 1, [1])]) == []          # no positives
    assert mined(spark, [(0, 0, [1]), (1, 0, [-1]), (2, 1, [-1])]) == []   # a score below 0 has an empty window
